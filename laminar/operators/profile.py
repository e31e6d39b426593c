"""Every per-state aggregate of the mart from one pass over the school table.

``GROUP BY GROUPING SETS ((school type, state), ())`` computes, in a single
scan and a single partial aggregation:

* per (type, state): the four band counts and the number of schools;
* for the whole table: the band totals (the shares' denominators) and the
  correlation moments (pair count, covariance and standard deviations,
  merged across tasks by Spark's own numerically stable buffers).

Everything after that runs on the aggregate's output, at most three rows
per state plus the grand total: a window over it spreads the grand total to
every row, a window per state sums the school counts of the state (k_u), and
the (type, state) rows are kept. One chain, so the large table is read
once (separate consumers would each get a differently pruned aggregate and
Spark could not share the exchange).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.functions import SOCIO_LEVELS
from laminar.functions.sqltext import (guarded_corr_sql, ordinal_sql, pair_moment_sqls, percent_sql,
                                       quote, school_type_sql)
from laminar.operators.bands import DEFAULT_BANDS, Bands

_BY_GROUP = 0     # grouping_id of the (type, state) set
_OVERALL = 3      # grouping_id of the grand total ()


def state_profile(schools: DataFrame, score: str = "enem_media_geral", state: str = "sigla_uf",
                  dependency: str = "dependencia_administrativa", label: str = "socio_economico",
                  levels: Sequence[str] = SOCIO_LEVELS, bands: Bands = DEFAULT_BANDS,
                  corr_name: str = "CORRELACAO_SOCIOECONOMICA_ENEM") -> DataFrame:
    """PORCENTAGEM_MEDIAS joined with INDICADOR: one row per (type, state) with
    band counts, band shares and the state's correlation.

    Equal to the reference's inner join of the two on state: a state with no
    scored school anywhere has no correlation row, so then no rows at all.
    Written as SQL expressions (a handful of driver calls for the whole plan).
    """
    sc, lab = quote(score), quote(label)
    scored = f"({lab} IS NOT NULL AND {sc} IS NOT NULL)"
    keyed = schools.selectExpr(
        f"{school_type_sql(quote(dependency))} AS TIPO_ESCOLA", f"{quote(state)} AS SIGLA_UF",
        f"CAST({sc} AS DOUBLE) AS _y", f"{scored} AS _scored",
        f"CASE WHEN {scored} THEN CAST({ordinal_sql(lab, levels)} AS DOUBLE) END AS _x")
    # _x is NULL outside the scored rows, so (x, y) pairs are exactly the scored pairs
    aggregates = [*bands.count_sqls("_y"), "count(1) AS _n", "count_if(_scored) AS _scored_rows",
                  *pair_moment_sqls("_x", "_y"), "grouping_id() AS _gid"]
    agg = keyed.groupingSets([["TIPO_ESCOLA", "SIGLA_UF"], []], "TIPO_ESCOLA", "SIGLA_UF").agg(
        *[F.expr(a) for a in aggregates])

    # windows over the aggregate's few rows only: the grand total to every row,
    # and k_u = schools of the state (sum over its type groups)
    totals = [*bands.names, "_scored_rows", "pairs", "cov", "sd_x", "sd_y"]
    spread = agg.selectExpr(
        "_gid", "TIPO_ESCOLA", "SIGLA_UF", *bands.names,
        *[f"max(CASE WHEN _gid = {_OVERALL} THEN {c} END) OVER () AS _t_{c}" for c in totals],
        f"sum(CASE WHEN _gid = {_BY_GROUP} THEN _n END) OVER (PARTITION BY SIGLA_UF) AS _k")
    # the reference joins the two CTEs on state: NULL states never match
    rows = spread.where(f"_gid = {_BY_GROUP} AND SIGLA_UF IS NOT NULL AND _t__scored_rows > 0")
    shares = [e for name, ratio in zip(bands.names, bands.ratio_names)
              for e in (name, f"{percent_sql(name, '_t_' + name)} AS {ratio}")]
    corr = guarded_corr_sql("_t_pairs * _k", "_t_cov", "_t_sd_x", "_t_sd_y")
    return rows.selectExpr("TIPO_ESCOLA", "SIGLA_UF", *shares, f"{corr} AS {quote(corr_name)}")
