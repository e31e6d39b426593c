"""Name and text helpers: contract renames, stringify, id prefix."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.functions._util import as_col

_WORD_BREAK = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def camel_to_snake(name: str) -> str:
    """'anoCenso' -> 'ano_censo', 'sanitarioPNE' -> 'sanitario_pne'.

    A break goes before an upper-case letter that follows a lower-case
    letter or digit; runs of capitals stay one word.
    """
    return _WORD_BREAK.sub("_", name).lower()


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by a literal map; names absent from ``df`` are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def stringify(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every column as text, except the names in ``keep`` (one ``selectExpr`` call)."""
    def q(c: str) -> str:
        return "`" + c.replace("`", "``") + "`"
    return df.selectExpr(*[q(c) if c in keep else f"CAST({q(c)} AS STRING) AS {q(c)}"
                           for c in df.columns])


def id_prefix(c, width: int = 7) -> Column:
    """The first ``width`` characters (Python ``row[0:7]``)."""
    return F.substring(as_col(c), 1, width)
