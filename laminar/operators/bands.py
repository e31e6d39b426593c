"""Score bands: conditional counts per group and their shares.

``BETWEEN`` is inclusive at both ends, so a score equal to an inner edge is
counted in two bands and a score under the first edge in none; NULL scores
count nowhere; NULL group keys form their own group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.functions import percent, school_type
from laminar.functions._util import as_col


@dataclass(frozen=True)
class Bands:
    """Four bands from four edges: [e0,e1], [e1,e2], [e2,e3], (e3, inf)."""

    # The score edges and the column names of the mart.
    edges: tuple[float, float, float, float] = (400, 500, 600, 700)
    names: tuple[str, str, str, str] = ("ENTRE_400_500", "ENTRE_500_600",
                                        "ENTRE_600_700", "MAIOR_700")
    ratio_names: tuple[str, str, str, str] = ("RATIO_400_500", "RATIO_500_600",
                                              "RATIO_600_700", "RATIO_MAIOR_700")

    def predicates(self, score) -> list[Column]:
        s = as_col(score)
        e0, e1, e2, e3 = self.edges
        return [s.between(e0, e1), s.between(e1, e2), s.between(e2, e3), s > e3]

    def counts(self, score) -> list[Column]:
        return [F.count_if(p).alias(n) for p, n in zip(self.predicates(score), self.names)]

    def count_sqls(self, score: str) -> list[str]:
        """SQL text of ``counts`` (``score`` is SQL text)."""
        e0, e1, e2, e3 = self.edges
        preds = [f"{score} BETWEEN {e0} AND {e1}", f"{score} BETWEEN {e1} AND {e2}",
                 f"{score} BETWEEN {e2} AND {e3}", f"{score} > {e3}"]
        return [f"count_if({p}) AS {n}" for p, n in zip(preds, self.names)]


DEFAULT_BANDS = Bands()


def band_counts(df: DataFrame, score: str, keys: list = (), bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """COUNTIF per band, grouped by ``keys`` (or one global row when ``keys`` is empty).

    Grouped counts aggregate partially on the map side, so only one small row
    per key and partition is shuffled, however skewed the keys are.
    """
    if keys:
        return df.groupBy(*keys).agg(*bands.counts(score))
    return df.agg(*bands.counts(score))


def band_groups(schools: DataFrame, score: str = "enem_media_geral", state: str = "sigla_uf",
                dependency: str = "dependencia_administrativa",
                bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """Band counts per (school type, state), plus ``N_ESCOLAS`` = schools in the group."""
    keyed = schools.select(school_type(dependency).alias("TIPO_ESCOLA"),
                           F.col(state).alias("SIGLA_UF"), F.col(score).alias("_score"))
    return keyed.groupBy("TIPO_ESCOLA", "SIGLA_UF").agg(
        *bands.counts("_score"), F.count(F.lit(1)).alias("N_ESCOLAS"))


def shares_from_groups(grouped: DataFrame, bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """PORCENTAGEM_MEDIAS from ``band_groups``.

    The totals are the same counts over the whole table (NULL types and
    states included), i.e. the sums of the grouped counts, taken as one
    scalar subquery over the grouped result: the school table is scanned
    once and no join with a one-row table is needed.
    """
    totals = grouped.select(
        F.struct(*[F.sum(n).alias(n) for n in bands.names]).alias("t")).scalar()
    cols = [F.col("TIPO_ESCOLA"), F.col("SIGLA_UF")]
    for name, ratio in zip(bands.names, bands.ratio_names):
        cols += [F.col(name), percent(F.col(name), totals.getField(name)).alias(ratio)]
    return grouped.select(*cols)


def band_shares(schools: DataFrame, score: str = "enem_media_geral", state: str = "sigla_uf",
                dependency: str = "dependencia_administrativa",
                bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """PORCENTAGEM_MEDIAS: per (school type, state) band counts and their share of all schools."""
    return shares_from_groups(band_groups(schools, score, state, dependency, bands), bands)
