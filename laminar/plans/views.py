"""Layer tables as temporary views, for users who query the layers in SQL.

After ``register_views(spark, paths)`` the reference's table names work in
``spark.sql``: ``api_escolas_raw``, ``api_escolas_trusted`` (and the same
for estatisticas / infraestrutura) and ``datamart_diretoria``. The views are
Parquet reads of what is committed when they are made, so filters and projections in the SQL reach the scans;
register them again after a run.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from laminar.plans import tables
from laminar.plans.contracts import INFRASTRUCTURE, SCHOOLS, STATISTICS
from laminar.plans.daily import LayerPaths
from laminar.plans.layers import read_raw, read_trusted

# The reference's table names per entity and layer.
VIEW_NAMES = {
    SCHOOLS.name: ("api_escolas_raw", "api_escolas_trusted"),
    STATISTICS.name: ("api_estatisticas_raw", "api_estatisticas_trusted"),
    INFRASTRUCTURE.name: ("api_infraestrutura_raw", "api_infraestrutura_trusted"),
}
MART_VIEW = "datamart_diretoria"


def register_views(spark: SparkSession, paths: LayerPaths) -> list[str]:
    """Create or replace the temp views of every written layer table; return their names."""
    names = []
    for contract in (SCHOOLS, STATISTICS, INFRASTRUCTURE):
        raw_name, trusted_name = VIEW_NAMES[contract.name]
        for name, table in ((raw_name, read_raw(spark, contract, paths.raw(contract))),
                            (trusted_name, read_trusted(spark, contract, paths.trusted(contract)))):
            table.createOrReplaceTempView(name)
            names.append(name)
    tables.read(spark, paths.mart).createOrReplaceTempView(MART_VIEW)
    names.append(MART_VIEW)
    return names
