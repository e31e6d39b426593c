"""laminar: layered (land / raw / trusted / refined) education-data analytics on Spark.

Every operator is a DataFrame or SQL expression; nothing is collected to the
driver except the row count that decides whether a per-state side may be
broadcast.
"""

__version__ = "0.1.0"
