"""Strict and safe casts from landed text to TRUSTED types.

The LAND and RAW layers hold every field as text; TRUSTED casts each one.
A malformed value fails the whole refresh, as in the reference's dialect;
``tolerant=True`` gives the ``try_`` form (NULL instead of failure).
There is one implementation, SQL text of built-in expressions: a contract of 135 fields becomes one
``selectExpr`` call instead of thousands of Python-side Column calls, and it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text forms of the date formats the reference parses,
# written as Spark datetime patterns ('%Y' and '%d/%m/%Y').
YEAR_PATTERN = "yyyy"
DAY_MONTH_YEAR_PATTERN = "d/M/yyyy"


# Spark's cast to double also takes what its Java parser takes: a type suffix ('1d', '1.5f ', '2D<tab>') and hexadecimal
# forms ('0x1p3'). Only a text with one of these letters needs the slow test of its whole form.
_ODD_LETTER = "[dDfFxX]"
_DECIMAL = r"^\\s*[+-]?(?:\\d+\\.?\\d*(?:[eE][+-]?\\d+)?|\\.\\d+(?:[eE][+-]?\\d+)?|(?i:inf|infinity|nan))\\s*$"

_TYPES = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "bool": T.BooleanType(), "year": T.DateType(),
          "dmy": T.DateType(), "safe_long": T.LongType(), "timestamp": T.TimestampType(), "date": T.DateType()}


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def result_type(type_word: str) -> T.DataType:
    """Spark type of a contract type word."""
    try:
        return _TYPES[type_word]
    except KeyError as exc:
        raise ValueError(f"unknown contract type {type_word!r}") from exc


def _bad(c: str, kind: str, sql_type: str, tolerant: bool) -> str:
    if tolerant:
        return f"CAST(NULL AS {sql_type})"
    return f"CAST(raise_error(concat('[CAST_INVALID_INPUT] cannot cast to {kind}: \"', {c}, '\"')) AS {sql_type})"


def _double(c: str, tolerant: bool) -> str:
    """CAST(x AS FLOAT64): decimal forms, 'NaN' and infinities; anything else is malformed."""
    cast = "TRY_CAST" if tolerant else "CAST"
    return (f"CASE WHEN {c} RLIKE '{_ODD_LETTER}' AND NOT {c} RLIKE '{_DECIMAL}' THEN {_bad(c, 'FLOAT64', 'DOUBLE', tolerant)} "
            f"ELSE {cast}({c} AS DOUBLE) END")


def _bool(c: str, tolerant: bool) -> str:
    """CAST(x AS BOOL): only 'true' / 'false' in any letter case (Spark's cast also takes 'yes', 't', '1')."""
    return (f"CASE lower({c}) WHEN 'true' THEN true WHEN 'false' THEN false ELSE "
            f"CASE WHEN {c} IS NOT NULL THEN {_bad(c, 'BOOL', 'BOOLEAN', tolerant)} END END")


def _safe_long(c: str, tolerant: bool) -> str:
    """SAFE_CAST(CAST(x AS FLOAT64) AS INT64): the inner cast is strict (tolerant: NULL); the outer one rounds half away
    from zero (2.5 -> 3, -2.5 -> -3; a bare cast truncates) and gives NULL for NaN, infinities and values out of range.
    2^63 itself, which Spark would clamp, is out of range; the double is computed once."""
    return f"TRY_CAST(nullif(round({_double(c, tolerant)}), {2.0 ** 63:.0f}D) AS BIGINT)"


def cast_sql(name: str, type_word: str, tolerant: bool = False) -> str:
    """SQL text of the cast of column ``name`` to the contract type ``type_word``."""
    result_type(type_word)
    c = quote(name)
    cast, to_date = ("TRY_CAST", "try_to_date") if tolerant else ("CAST", "to_date")
    if type_word in ("bool", "double", "safe_long"):
        return {"bool": _bool, "double": _double, "safe_long": _safe_long}[type_word](c, tolerant)
    return {"string": f"CAST({c} AS STRING)", "long": f"{cast}({c} AS BIGINT)",     # '1.0', 'abc' and '' are malformed
            "timestamp": f"{cast}({c} AS TIMESTAMP)", "date": f"{cast}({c} AS DATE)",
            "year": f"{to_date}({c}, '{YEAR_PATTERN}')",                             # 1 January of the year
            "dmy": f"{to_date}({c}, '{DAY_MONTH_YEAR_PATTERN}')"}[type_word]         # takes 1/2/2015 and 01/02/2015, rejects 31/02


def cast_to(name: str, type_word: str, tolerant: bool = False) -> Column:
    """``cast_sql`` as a Column."""
    return F.expr(cast_sql(name, type_word, tolerant))
