"""The school model on the driver's test tables.

A school is a ``customer`` row, its state the customer's nation name, its
score ``c_acctbal`` (bands 4000-5000-6000-7000), its socio-economic label
``c_mktsegment`` and its dependency code ``pmod(c_custkey, 5) + 1`` (codes 1-5,
so every state has public, private and untyped schools). State statistics
are ``supplier`` balances averaged per nation, one row per state as in the
reference. The frames carry the TRUSTED column names, so the mart code runs
on them unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.operators import Bands

# Fixed values of the analogue: segment labels, lowest first (MACHINERY is
# left unmapped so its ordinal is NULL), and the score bands.
SEGMENT_LEVELS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")
ANALOGUE_BANDS = Bands(edges=(4000, 5000, 6000, 7000))

# Dependency code -> label of the analogue.
DEPENDENCY_LABELS = ("Federal", "Estadual", "Municipal", "Privada", "Outra")

# Score column -> divisor used to derive the subject scores from the balance.
SUBJECT_DIVISORS = (("enem_portugues", 2), ("enem_matematica", 4), ("enem_humanas", 5),
                    ("enem_naturais", 8), ("enem_redacao", 10))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer LEFT JOIN nation as a TRUSTED-shaped school table.

    The projection is SQL text in one ``selectExpr`` call: a few driver round
    trips instead of hundreds of Python Column calls.
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    dep = "(pmod(c_custkey, 5) + 1)"
    labels = " ".join(f"WHEN {dep} = {i} THEN '{lab}'" for i, lab in enumerate(DEPENDENCY_LABELS, 1))
    joined = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    return joined.selectExpr(
        "CAST(c_custkey AS STRING) AS cod",
        "c_name AS nome",
        "c_mktsegment AS nome_municipio",
        "n_name AS sigla_uf",
        "CASE WHEN c_acctbal >= 0 THEN 'Urbana' ELSE 'Rural' END AS tipo_localizacao_txt",
        f"CAST({dep} AS BIGINT) AS dependencia_administrativa",
        f"CASE {labels} END AS dependencia_administrativa_txt",
        "make_date(2019 + n_regionkey, 1, 1) AS ano_censo",
        *[f"c_acctbal / {d} AS {name}" for name, d in SUBJECT_DIVISORS],
        "c_acctbal AS enem_media_geral",
        "c_acctbal / 1000 AS ideb_af",
        "c_mktsegment AS socio_economico",
    )


def statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier JOIN nation, averaged per nation: one statistics row per state."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    per_state = (s.join(n, s["s_nationkey"] == n["n_nationkey"], "inner")
                 .groupBy("n_name").agg(F.avg("s_acctbal").alias("_mean")))
    return per_state.selectExpr(
        "n_name AS nome_local",
        *[f"round(_mean / {d}, 6) AS {name}" for name, d in SUBJECT_DIVISORS],
        "round(_mean, 6) AS enem_media_geral",
        "round(_mean / 1000, 6) AS ideb_af",
    )


def schools_sql() -> str:
    """The same school table as a DuckDB / ANSI SQL subquery (for the oracles)."""
    dep = "((c_custkey % 5 + 5) % 5 + 1)"
    labels = " ".join(f"WHEN {dep} = {i} THEN '{lab}'" for i, lab in enumerate(DEPENDENCY_LABELS, 1))
    subjects = ", ".join(f"c_acctbal / {d} AS {name}" for name, d in SUBJECT_DIVISORS)
    return f"""(SELECT CAST(c_custkey AS VARCHAR) AS cod, c_name AS nome,
        c_mktsegment AS nome_municipio, n_name AS sigla_uf,
        CASE WHEN c_acctbal >= 0 THEN 'Urbana' ELSE 'Rural' END AS tipo_localizacao_txt,
        CAST({dep} AS BIGINT) AS dependencia_administrativa,
        CASE {labels} END AS dependencia_administrativa_txt,
        make_date(CAST(2019 + n_regionkey AS INTEGER), 1, 1) AS ano_censo,
        {subjects}, c_acctbal AS enem_media_geral, c_acctbal / 1000 AS ideb_af,
        c_mktsegment AS socio_economico
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""


def statistics_sql() -> str:
    subjects = ", ".join(f"round(avg(s_acctbal) / {d}, 6) AS {name}" for name, d in SUBJECT_DIVISORS)
    return f"""(SELECT n_name AS nome_local, {subjects},
        round(avg(s_acctbal), 6) AS enem_media_geral, round(avg(s_acctbal) / 1000, 6) AS ideb_af
      FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name)"""


def ordinal_sql(column: str, levels=SEGMENT_LEVELS) -> str:
    whens = " ".join(f"WHEN {column} = '{lab}' THEN {i}" for i, lab in enumerate(levels))
    return f"CAST(CASE {whens} END AS BIGINT)"
