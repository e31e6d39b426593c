"""Label mappings written as CASE expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from laminar.functions._util import as_col

# The socio-economic labels of the school data, lowest first;
# the ordinal of a label is its position (Baixo 0 ... Muito Alto 5).
SOCIO_LEVELS = ("Baixo", "Médio Baixo", "Médio", "Médio Alto", "Alto", "Muito Alto")

# Administrative dependency codes and school-type labels.
PUBLIC_DEPENDENCIES = (1, 2, 3)
PRIVATE_DEPENDENCY = 4
PUBLIC_LABEL = "Pública"
PRIVATE_LABEL = "Privada"


def ordinal(c, levels: Sequence[str] = SOCIO_LEVELS) -> Column:
    """Position of the label in ``levels``; exact, accent-sensitive match, else NULL."""
    c = as_col(c)
    expr = None
    for rank, label in enumerate(levels):
        expr = (F.when(c == label, F.lit(rank)) if expr is None
                else expr.when(c == label, F.lit(rank)))
    return expr.cast("bigint")


def school_type(dependency) -> Column:
    """1, 2, 3 -> 'Pública'; 4 -> 'Privada'; anything else (and NULL) -> NULL."""
    dep = as_col(dependency)
    return (F.when(dep.isin(*PUBLIC_DEPENDENCIES), F.lit(PUBLIC_LABEL))
            .when(dep == PRIVATE_DEPENDENCY, F.lit(PRIVATE_LABEL)))


def request_school_type(dependency) -> Column:
    """Request parameter -> label: 4 is 'Privada', every other value 'Pública'."""
    dep = as_col(dependency)
    return F.when(dep == PRIVATE_DEPENDENCY, F.lit(PRIVATE_LABEL)).otherwise(F.lit(PUBLIC_LABEL))
