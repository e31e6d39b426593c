"""The socio-economic correlation indicator in O(n).

The reference correlates (ordinal, score) over the cross join of the scored
schools S with all schools, grouped by the state of the second side. Group u
therefore holds every pair of S repeated k_u times (k_u = schools of state
u). Repeating all pairs the same number of times leaves a correlation
unchanged, so the value is the correlation over S for every state, and only
the "fewer than two pairs" rule depends on k_u (m * k_u < 2, m = pairs with
both values present). Nothing pairs rows: one global aggregate over S, one
count per state, from one grouping-sets aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.functions import SOCIO_LEVELS
from laminar.functions.sqltext import guarded_corr_sql, ordinal_sql, pair_moment_sqls, quote


def socio_correlation(schools: DataFrame, label: str = "socio_economico",
                      score: str = "enem_media_geral", state: str = "sigla_uf",
                      levels: Sequence[str] = SOCIO_LEVELS,
                      out: str = "CORRELACAO_SOCIOECONOMICA_ENEM") -> DataFrame:
    """INDICADOR: one row per distinct state (NULL included) with the correlation.

    One pass: ``GROUPING SETS ((state), ())`` gives the school count of each
    state and, in the grand-total row, the moments over the scored schools;
    a window over that small result hands the moments to every state row.
    No rows at all when no school has both a label and a score (the
    reference's cross join is then empty).
    """
    lab, sc = quote(label), quote(score)
    scored = f"({lab} IS NOT NULL AND {sc} IS NOT NULL)"
    keyed = schools.selectExpr(
        f"{quote(state)} AS SIGLA_UF", f"{scored} AS _scored", f"CAST({sc} AS DOUBLE) AS _y",
        f"CASE WHEN {scored} THEN CAST({ordinal_sql(lab, levels)} AS DOUBLE) END AS _x")
    # _x is NULL outside the scored rows, so (x, y) pairs are exactly the scored pairs
    aggregates = ["count(1) AS _k", "count_if(_scored) AS _rows", *pair_moment_sqls("_x", "_y"),
                  "grouping_id() AS _gid"]
    agg = keyed.groupingSets([["SIGLA_UF"], []], "SIGLA_UF").agg(*[F.expr(a) for a in aggregates])
    # a window over one row per state plus the grand total hands the moments to every state
    spread = agg.selectExpr("_gid", "SIGLA_UF", "_k", *[
        f"max(CASE WHEN _gid = 1 THEN {c} END) OVER () AS _t{c}"
        for c in ("_rows", "pairs", "cov", "sd_x", "sd_y")])
    corr = guarded_corr_sql("_tpairs * _k", "_tcov", "_tsd_x", "_tsd_y")
    return spread.where("_gid = 0 AND _t_rows > 0").selectExpr(f"{corr} AS {quote(out)}", "SIGLA_UF")
