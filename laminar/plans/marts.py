"""The refined mart ``datamart_diretoria``.

Plan shape: the school table is the only large input and is never shuffled.
Everything else is keyed by state and small: the statistics (one row per
state) and the band shares with the correlation (one row per school type
present in a state, from one grouping-sets pass, ``state_profile``). They
are joined while small. ``write_datamart`` writes that side first: its bytes are then known to
the planner, which broadcasts it up to ``spark.sql.autoBroadcastJoinThreshold`` (the school scan
streams through one hash join, unshuffled) and shuffles both sides beyond it. ``build_datamart`` is the lazy form:
one plan in which adaptive execution decides by the measured bytes. Inner joins drop schools whose state is NULL or has no
statistics row; a school repeats once per school type present in its state
(the reference's fan-out, kept on purpose).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.functions import SOCIO_LEVELS
from laminar.functions.sqltext import ordinal_sql, quote
from laminar.operators import DEFAULT_BANDS, Bands
from laminar.operators.profile import state_profile
from laminar.plans import tables
from laminar.session import release, workspace

# Mart column <- school column, in the mart's order (MEDIAS).
SCHOOL_COLUMNS = (
    ("ESCOLA", "nome"),
    ("MUNICIPIO", "nome_municipio"),
    ("SIGLA_UF", "sigla_uf"),
    ("TIPO_LOCALIZACAO", "tipo_localizacao_txt"),
    ("DEPENDENCIA_ADMINSTRATIVA", "dependencia_administrativa_txt"),
    ("ANO_CENSO", "ano_censo"),
    ("MEDIA_ENEM_PORTUGUES", "enem_portugues"),
    ("MEDIA_ENEM_MATEMATICA", "enem_matematica"),
    ("MEDIA_ENEM_HUMANAS", "enem_humanas"),
    ("MEDIA_ENEM_NATURAIS", "enem_naturais"),
    ("MEDIA_ENEM_REDACAO", "enem_redacao"),
    ("MEDIA_ENEM_GERAL", "enem_media_geral"),
    ("IDEB_NOTA", "ideb_af"),
)

# Mart column <- state statistics column (MEDIAS).
STATE_COLUMNS = (
    ("ESTADO_MEDIA_ENEM_PORTUGUES", "enem_portugues"),
    ("ESTADO_MEDIA_ENEM_MATEMATICA", "enem_matematica"),
    ("ESTADO_MEDIA_ENEM_HUMANAS", "enem_humanas"),
    ("ESTADO_MEDIA_ENEM_NATURAIS", "enem_naturais"),
    ("ESTADO_MEDIA_ENEM_REDACAO", "enem_redacao"),
    ("ESTADO_MEDIA_ENEM_GERAL", "enem_media_geral"),
    ("ESTADO_IDEB_NOTA", "ideb_af"),
)

SOCIO_COLUMN = "SOCIO_ECONOMICO"
SOCIO_NUMBER = "SOCIO_ECONOMICO_NUMERO"
CORR_COLUMN = "CORRELACAO_SOCIOECONOMICA_ENEM"


def mart_columns(bands: Bands = DEFAULT_BANDS) -> list[str]:
    """The 32 output columns in order."""
    cols = [m for m, _ in SCHOOL_COLUMNS] + [m for m, _ in STATE_COLUMNS]
    cols += [SOCIO_COLUMN, SOCIO_NUMBER, CORR_COLUMN, "TIPO_ESCOLA"]
    for name, ratio in zip(bands.names, bands.ratio_names):
        cols += [name, ratio]
    return cols


def _school_rows(schools: DataFrame, levels: Sequence[str]) -> DataFrame:
    """The school side of MEDIAS: renamed columns and the label ordinal (one selectExpr)."""
    return schools.selectExpr(*[f"{quote(src)} AS {dst}" for dst, src in SCHOOL_COLUMNS],
                              f"socio_economico AS {SOCIO_COLUMN}",
                              f"{ordinal_sql('socio_economico', levels)} AS {SOCIO_NUMBER}")


def school_means(schools: DataFrame, statistics: DataFrame, levels: Sequence[str] = SOCIO_LEVELS,
                 state_key: str = "nome_local") -> DataFrame:
    """MEDIAS: each school with its state's statistics (inner join on state) and the label ordinal."""
    stats = statistics.select(F.col(state_key).alias("_uf"),
                              *[F.col(src).alias(dst) for dst, src in STATE_COLUMNS])
    left = _school_rows(schools, levels)
    joined = left.join(stats, left["SIGLA_UF"] == stats["_uf"], "inner")
    return joined.select([m for m, _ in SCHOOL_COLUMNS] + [m for m, _ in STATE_COLUMNS]
                         + [SOCIO_COLUMN, SOCIO_NUMBER])


def state_side(schools: DataFrame, statistics: DataFrame, levels: Sequence[str] = SOCIO_LEVELS,
               bands: Bands = DEFAULT_BANDS, state_key: str = "nome_local") -> DataFrame:
    """Everything the mart attaches per state, joined while it is small.

    statistics (one row per state) x band shares and correlation (one row
    per school type present in the state, from ``state_profile``), on state.
    Inner joins on one key are associative, so joining these first and the
    schools last gives the reference's rows, with one probe per school.
    """
    stats = statistics.select(F.col(state_key).alias("_uf"),
                              *[F.col(src).alias(dst) for dst, src in STATE_COLUMNS])
    profile = state_profile(schools, levels=levels, bands=bands).withColumnRenamed("SIGLA_UF", "_uf_p")
    return stats.join(profile, stats["_uf"] == profile["_uf_p"], "inner").drop("_uf_p")


def join_state_side(schools: DataFrame, side: DataFrame, levels: Sequence[str] = SOCIO_LEVELS,
                    bands: Bands = DEFAULT_BANDS) -> DataFrame:
    """The school rows joined with the per-state side -> the 32 mart columns."""
    left = _school_rows(schools, levels)
    joined = left.join(side, left["SIGLA_UF"] == side["_uf"], "inner")
    return joined.select(mart_columns(bands))


def build_datamart(schools: DataFrame, statistics: DataFrame, levels: Sequence[str] = SOCIO_LEVELS,
                   bands: Bands = DEFAULT_BANDS, state_key: str = "nome_local") -> DataFrame:
    """MEDIAS x PORCENTAGEM_MEDIAS x INDICADOR on state -> the 32-column mart, lazily (no job, no cache).

    The school table is scanned for the per-state aggregates (column-pruned,
    partially aggregated) and once more for the output rows.
    """
    return join_state_side(schools, state_side(schools, statistics, levels, bands, state_key), levels, bands)


def write_datamart(schools: DataFrame, statistics: DataFrame, path: str,
                   levels: Sequence[str] = SOCIO_LEVELS, bands: Bands = DEFAULT_BANDS,
                   state_key: str = "nome_local") -> None:
    """Build the mart and write it as a full replace, no partitioning."""
    spark = schools.sparkSession
    written = workspace(spark, "state-side")
    side = state_side(schools, statistics, levels, bands, state_key)
    side.coalesce(1).write.parquet(written)         # at most three rows per state
    try:
        known = spark.read.schema(side.schema).parquet(written)
        tables.replace(join_state_side(schools, known, levels, bands), path)
    finally:
        release(spark, [written])
