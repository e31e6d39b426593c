"""SQL-text forms of the expressions used in wide or many-column plans.

Building a Column in PySpark costs a dozen driver round trips; the same
expression as SQL text is parsed once in the JVM (``selectExpr`` /
``F.expr``). Each function here mirrors a Column builder of this package,
and ``tests/test_functions.py`` checks that both forms agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from laminar.functions.casts import quote
from laminar.functions.categorical import (PRIVATE_DEPENDENCY, PRIVATE_LABEL, PUBLIC_DEPENDENCIES,
                                           PUBLIC_LABEL, SOCIO_LEVELS)


def literal(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def school_type_sql(dependency: str) -> str:
    """Mirror of ``categorical.school_type`` (``dependency`` is SQL text)."""
    public = ", ".join(str(d) for d in PUBLIC_DEPENDENCIES)
    return (f"CASE WHEN {dependency} IN ({public}) THEN {literal(PUBLIC_LABEL)} "
            f"WHEN {dependency} = {PRIVATE_DEPENDENCY} THEN {literal(PRIVATE_LABEL)} END")


def ordinal_sql(column: str, levels: Sequence[str] = SOCIO_LEVELS) -> str:
    """Mirror of ``categorical.ordinal``."""
    whens = " ".join(f"WHEN {column} = {literal(label)} THEN {rank}" for rank, label in enumerate(levels))
    return f"CAST(CASE {whens} END AS BIGINT)"


def percent_sql(a: str, b: str) -> str:
    """Mirror of ``arith.percent``: SAFE_DIVIDE(a, b) * 100."""
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) * 100"


def guarded_corr_sql(n_pairs: str, covar_pop: str, sd_x: str, sd_y: str) -> str:
    """CORR from moments with the reference's edge rules, without raising.

    Fewer than two pairs -> NULL; zero variance or NaN input -> NaN; Spark's
    own ``corr`` raises DIVIDE_BY_ZERO on zero variance under ANSI.
    """
    return (f"CASE WHEN {n_pairs} < 2 THEN CAST(NULL AS DOUBLE) "
            f"ELSE coalesce(try_divide({covar_pop}, {sd_x} * {sd_y}), CAST('NaN' AS DOUBLE)) END")


def pair_moment_sqls(x: str, y: str) -> list[str]:
    """Aggregates over the pairs where both x and y are present (pairwise deletion)."""
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    xs, ys = f"CASE WHEN {both} THEN {x} END", f"CASE WHEN {both} THEN {y} END"
    return [f"count_if({both}) AS pairs", f"covar_pop({xs}, {ys}) AS cov",
            f"stddev_pop({xs}) AS sd_x", f"stddev_pop({ys}) AS sd_y"]


__all__ = ["literal", "quote", "school_type_sql", "ordinal_sql", "percent_sql", "guarded_corr_sql",
           "pair_moment_sqls"]
