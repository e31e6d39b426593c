"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from laminar.functions.arith import percent, safe_divide
from laminar.functions.casts import cast_sql, cast_to
from laminar.functions.categorical import (SOCIO_LEVELS, ordinal, request_school_type,
                                           school_type)
from laminar.functions.text import camel_to_snake, id_prefix, rename_columns, stringify

__all__ = [
    "percent", "safe_divide", "cast_sql", "cast_to", "SOCIO_LEVELS", "ordinal",
    "request_school_type", "school_type", "camel_to_snake", "id_prefix", "rename_columns",
    "stringify",
]
