"""The driver's query catalog: each SURVEY §7.3 query on the test tables, and its SQL oracle.

Every query reads whole tables from ``sf_dir``. Floating results that come
from aggregates are rounded to 6 decimals in both the Spark query and the
oracle, because the two engines sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laminar.functions import ordinal, school_type, stringify
from laminar.operators import band_counts, band_shares, socio_correlation
from laminar.operators.indicators import against_overall, growth_vs_total, rank_states
from laminar.plans import analogue as A
from laminar.plans import layers, tables
from laminar.plans.analogue_payloads import (CAPITAL_ID, CAPITAL_NATION, CAPITAL_SHARDS, request_grid,
                                             write_payloads)
from laminar.plans.contracts import INFRASTRUCTURE, SCHOOLS, STATISTICS, Contract, Field
from laminar.plans.daily import (LayerPaths, extract_infrastructure, extract_schools, extract_statistics, refine,
                                 run_daily)
from laminar.plans.marts import school_means, write_datamart
from laminar.session import workspace
from laminar.sources import (KeyAudit, bag_union, city_ids, envelope_ids, flatten_infrastructure, id_lookup,
                             parameter_grid, parse_objects, shard_filter)
from laminar.streaming import stream_land_to_raw

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def _round(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


BANDS = A.ANALOGUE_BANDS
_S = A.schools_sql()
_ST = A.statistics_sql()


def _band_sql(score: str) -> list[str]:
    e0, e1, e2, e3 = BANDS.edges
    preds = [f"{score} BETWEEN {e0} AND {e1}", f"{score} BETWEEN {e1} AND {e2}",
             f"{score} BETWEEN {e2} AND {e3}", f"{score} > {e3}"]
    # COUNTIF is INT64 in the reference (DuckDB's count_if would be HUGEINT)
    return [f"CAST(count_if({p}) AS BIGINT)" for p in preds]


_TYPE_SQL = ("CASE WHEN dependencia_administrativa IN (1, 2, 3) THEN 'Pública' "
             "WHEN dependencia_administrativa = 4 THEN 'Privada' END")

# --------------------------------------------------------------- bands

def _type_groups_sql(schools: str) -> str:
    return f"""
SELECT {_TYPE_SQL} AS TIPO_ESCOLA, sigla_uf AS SIGLA_UF,
  {", ".join(f"{c} AS {n}" for c, n in zip(_band_sql("enem_media_geral"), BANDS.names))}
FROM {schools} s GROUP BY 1, 2"""


_TYPE_GROUPS_SQL = _type_groups_sql(_S)


@query("type_groups", _TYPE_GROUPS_SQL)
def q_type_groups(spark, sf_dir):
    s = A.schools(spark, sf_dir)
    keyed = s.select(school_type("dependencia_administrativa").alias("TIPO_ESCOLA"),
                     F.col("sigla_uf").alias("SIGLA_UF"), "enem_media_geral")
    return band_counts(keyed, "enem_media_geral", ["TIPO_ESCOLA", "SIGLA_UF"], BANDS)


@query("band_totals", f"""
SELECT {", ".join(f"{c} AS {n}" for c, n in zip(_band_sql("enem_media_geral"), BANDS.names))}
FROM {_S} s""")
def q_band_totals(spark, sf_dir):
    return band_counts(A.schools(spark, sf_dir), "enem_media_geral", [], BANDS)


def _band_share_sql(schools: str) -> str:
    return f"""
WITH g AS ({_type_groups_sql(schools)}),
t AS (SELECT {", ".join(f"{c} AS {n}" for c, n in zip(_band_sql("enem_media_geral"), BANDS.names))}
      FROM {schools} s)
SELECT g.TIPO_ESCOLA, g.SIGLA_UF,
  {", ".join(f"g.{n}, round(g.{n} / NULLIF(t.{n}, 0) * 100, 6) AS {r}"
             for n, r in zip(BANDS.names, BANDS.ratio_names))}
FROM g, t"""


_BAND_SHARE_SQL = _band_share_sql(_S)


@query("band_share", _BAND_SHARE_SQL)
def q_band_share(spark, sf_dir):
    out = band_shares(A.schools(spark, sf_dir), bands=BANDS)
    return _round(out, BANDS.ratio_names)


# --------------------------------------------------------------- correlation

def _corr_sql(schools: str) -> str:
    return f"""
WITH s AS {schools},
ind AS (SELECT {A.ordinal_sql("socio_economico")} AS x, enem_media_geral AS y
        FROM s WHERE socio_economico IS NOT NULL AND enem_media_geral IS NOT NULL),
dados AS (SELECT sigla_uf FROM s)
SELECT round(CASE WHEN count(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 END) < 2 THEN NULL
                  ELSE corr(x, y) END, 6) AS CORRELACAO_SOCIOECONOMICA_ENEM,
       dados.sigla_uf AS SIGLA_UF
FROM ind, dados GROUP BY dados.sigla_uf"""


_CORR_SQL = _corr_sql(_S)


@query("corr_by_group", _CORR_SQL)
def q_corr_by_group(spark, sf_dir):
    out = socio_correlation(A.schools(spark, sf_dir), levels=A.SEGMENT_LEVELS)
    return _round(out, ["CORRELACAO_SOCIOECONOMICA_ENEM"])


# --------------------------------------------------------------- means and mart

def _medias_sql(schools: str, statistics: str) -> str:
    return f"""
SELECT es.nome AS ESCOLA, es.nome_municipio AS MUNICIPIO, es.sigla_uf AS SIGLA_UF,
  es.tipo_localizacao_txt AS TIPO_LOCALIZACAO,
  es.dependencia_administrativa_txt AS DEPENDENCIA_ADMINSTRATIVA, es.ano_censo AS ANO_CENSO,
  es.enem_portugues AS MEDIA_ENEM_PORTUGUES, es.enem_matematica AS MEDIA_ENEM_MATEMATICA,
  es.enem_humanas AS MEDIA_ENEM_HUMANAS, es.enem_naturais AS MEDIA_ENEM_NATURAIS,
  es.enem_redacao AS MEDIA_ENEM_REDACAO, es.enem_media_geral AS MEDIA_ENEM_GERAL,
  es.ideb_af AS IDEB_NOTA,
  st.enem_portugues AS ESTADO_MEDIA_ENEM_PORTUGUES, st.enem_matematica AS ESTADO_MEDIA_ENEM_MATEMATICA,
  st.enem_humanas AS ESTADO_MEDIA_ENEM_HUMANAS, st.enem_naturais AS ESTADO_MEDIA_ENEM_NATURAIS,
  st.enem_redacao AS ESTADO_MEDIA_ENEM_REDACAO, st.enem_media_geral AS ESTADO_MEDIA_ENEM_GERAL,
  st.ideb_af AS ESTADO_IDEB_NOTA, es.socio_economico AS SOCIO_ECONOMICO,
  {A.ordinal_sql("es.socio_economico")} AS SOCIO_ECONOMICO_NUMERO
FROM {schools} es JOIN {statistics} st ON es.sigla_uf = st.nome_local"""


_MEDIAS_SQL = _medias_sql(_S, _ST)


@query("state_join", _MEDIAS_SQL)
def q_state_join(spark, sf_dir):
    return school_means(A.schools(spark, sf_dir), A.statistics(spark, sf_dir),
                        levels=A.SEGMENT_LEVELS)


def _datamart_sql(schools: str, statistics: str) -> str:
    return f"""
WITH m AS ({_medias_sql(schools, statistics)}), p AS ({_band_share_sql(schools)}),
  i AS ({_corr_sql(schools)})
SELECT m.*, i.CORRELACAO_SOCIOECONOMICA_ENEM, p.TIPO_ESCOLA,
  {", ".join(f"p.{n}, p.{r}" for n, r in zip(BANDS.names, BANDS.ratio_names))}
FROM m JOIN p ON m.SIGLA_UF = p.SIGLA_UF JOIN i ON m.SIGLA_UF = i.SIGLA_UF"""


_DATAMART_SQL = _datamart_sql(_S, _ST)


@query("datamart", _DATAMART_SQL)
def q_datamart(spark, sf_dir):
    """The mart as the daily job writes it (per-state side first, then one probe per school), read back."""
    path = f"{workspace(spark, 'datamart')}/mart"
    write_datamart(A.schools(spark, sf_dir), A.statistics(spark, sf_dir), path, A.SEGMENT_LEVELS, BANDS)
    return _round(tables.read(spark, path), ["CORRELACAO_SOCIOECONOMICA_ENEM", *BANDS.ratio_names])


def _daily_schools_sql() -> str:
    """The schools the daily run finds: the capital's shard searches (a bag) and every
    listed city's search, each matched to its detail object."""
    shards = " UNION ALL ".join(
        f"SELECT c_custkey AS id FROM customer WHERE c_nationkey = {CAPITAL_NATION} "
        f"AND c_acctbal BETWEEN {lo} AND {hi}" for lo, hi in CAPITAL_SHARDS)
    cities = (f"SELECT c_custkey AS id FROM customer JOIN nation ON c_nationkey = n_nationkey "
              f"WHERE c_nationkey <> {CAPITAL_NATION}")
    return f"(SELECT s.* FROM ({shards} UNION ALL {cities}) ids JOIN {_S} s ON s.cod = CAST(ids.id AS VARCHAR))"


def _states(spark, sf_dir) -> DataFrame:
    """The states whose statistics are requested: the nations that have suppliers."""
    s, n = _table(spark, sf_dir, "supplier"), _table(spark, sf_dir, "nation")
    return s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.col("n_name").alias("nome_local")).distinct()


_RUN_AT = datetime(2024, 5, 2, 12, 0)


@query("daily_run", _datamart_sql(_daily_schools_sql(), _ST))
def q_daily_run(spark, sf_dir):
    """U1-U10 end to end: payload folder derived from the tables -> LAND -> RAW ->
    TRUSTED (latest batch, strict casts) -> mart, LAND truncated; returns the mart."""
    root = workspace(spark, "daily_run")
    payloads = write_payloads(spark, sf_dir, f"{root}/payloads")
    paths = run_daily(spark, payloads, f"{root}/lake", now=_RUN_AT, lines=True, states=_states(spark, sf_dir),
                      requests=request_grid(_table(spark, sf_dir, "orders")),
                      levels=A.SEGMENT_LEVELS, bands=BANDS, capital=CAPITAL_ID)
    return _round(tables.read(spark, paths.mart), ["CORRELACAO_SOCIOECONOMICA_ENEM", *BANDS.ratio_names])


@query("daily_infrastructure", """
WITH n AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS ano, CASE WHEN o_orderstatus = 'F' THEN 4 ELSE 5 END AS dep, o_orderpriority, o_orderstatus,
         count(*) AS n FROM orders GROUP BY ALL),
t AS (SELECT *, sum(n) OVER (PARTITION BY ano, dep) AS total FROM n)
SELECT CAST(NULL AS VARCHAR) AS id, o_orderpriority AS secao, o_orderstatus AS tema, o_orderstatus AS entidade,
  round(n * 100 / total, 4) AS porcentagem, CAST(n + 1 AS BIGINT) AS escolas, lower(o_orderstatus) AS sigla_uf,
  CAST(total AS BIGINT) AS total_escolas, ano, CASE WHEN dep = 4 THEN 'Privada' ELSE 'Pública' END AS tipo_escolas
FROM t""")
def q_daily_infrastructure(spark, sf_dir):
    """TRUSTED infrastructure, copied to RAW by the stream, driven by the request table of every order
    year and dependency."""
    requests = request_grid(_table(spark, sf_dir, "orders"))
    return _trusted(spark, sf_dir, INFRASTRUCTURE, lambda d, _: extract_infrastructure(spark, d, requests, lines=True), raw_stream=True)


def _trusted(spark, sf_dir, contract, extract, **options) -> DataFrame:
    """One entity's chain, payloads -> LAND -> RAW -> TRUSTED, over a payload folder derived from the tables."""
    root = workspace(spark, f"daily_{contract.name}")
    payloads, paths = write_payloads(spark, sf_dir, f"{root}/payloads"), LayerPaths(f"{root}/lake")
    audit = KeyAudit(contract) if contract is not INFRASTRUCTURE else None
    refine(spark, contract, extract(payloads, audit), paths, layers.batch_instant(_RUN_AT), _RUN_AT, audit, **options)
    return layers.read_trusted(spark, contract, paths.trusted(contract)).select(contract.land_columns)


def _wide_sql(contract: Contract, special: dict[str, str], by_kind: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{special.get(f.land, by_kind[f.kind])} AS {f.land}" for f in contract.fields) + f" FROM {source}"


_SCHOOL_KINDS = {"string": "c_name", "long": "CAST((c_custkey % 97 + 97) % 97 AS BIGINT)", "double": "c_acctbal", "bool": "c_custkey % 2 = 0",
                 "year": "DATE '2020-01-01'",
                 "dmy": "make_date(2020, CAST((c_custkey % 12 + 12) % 12 + 1 AS INTEGER), CAST((c_custkey % 28 + 28) % 28 + 1 AS INTEGER))"}
_SCHOOL_FIELDS = {c: f"s.{c}" for c in ("cod", "nome", "nome_municipio", "sigla_uf", "tipo_localizacao_txt", "dependencia_administrativa",
                                        "dependencia_administrativa_txt", "ano_censo", "enem_media_geral", "ideb_af", "socio_economico",
                                        *(name for name, _ in A.SUBJECT_DIVISORS))}


@query("daily_schools", _wide_sql(SCHOOLS, _SCHOOL_FIELDS, _SCHOOL_KINDS,
                                  f"{_daily_schools_sql()} s JOIN customer ON s.cod = CAST(c_custkey AS VARCHAR)"))
def q_daily_schools(spark, sf_dir):
    """All 135 TRUSTED school columns, capital shards with their repeats, every listed city searched."""
    return _trusted(spark, sf_dir, SCHOOLS, lambda d, audit: extract_schools(spark, d, audit, lines=True, capital=CAPITAL_ID))


_STATE_MEAN = "(SELECT n_nationkey, n_name, avg(s_acctbal) AS m FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)"
_STATE_FIELDS = ({"id": "CAST(n_nationkey AS VARCHAR)", "ano": "CAST(2023 AS BIGINT)", "tipo_local": "'EST'", "nome_local": "n_name",
                  "cod_municipio": "CAST(0 AS BIGINT)", "melhores": "CAST(0 AS BIGINT)", "ideb_af": "round(m / 1000, 6)"}
                 | {name: f"round(m / {d}, 6)" for name, d in A.SUBJECT_DIVISORS})


@query("daily_statistics", _wide_sql(STATISTICS, _STATE_FIELDS, {"double": "round(m, 6)"} | dict.fromkeys(("string", "long"), "NULL"), _STATE_MEAN))
def q_daily_statistics(spark, sf_dir):
    """All 100 TRUSTED statistics columns of the requested states."""
    return _trusted(spark, sf_dir, STATISTICS, lambda d, audit: extract_statistics(spark, d, _states(spark, sf_dir), audit))


# =============================================================== casts and projections

def _table(spark, sf_dir, name):
    return A.table(spark, sf_dir, name)


LINEITEM_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                    "l_shipdate")


@query("raw_projection", f"SELECT {', '.join(LINEITEM_COLUMNS)} FROM lineitem")
def q_raw_projection(spark, sf_dir):
    """The explicit RAW column list over a whole table."""
    li = _table(spark, sf_dir, "lineitem")
    contract = Contract.from_schema("lineitem", li.select(*LINEITEM_COLUMNS).schema, "l_orderkey")
    contract.check(li)
    return li.select(*contract.land_columns)


@query("typed_cast", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, (l_linestatus = 'F') AS l_is_final
FROM lineitem""")
def q_typed_cast(spark, sf_dir):
    """Lineitem landed as text, then the strict TRUSTED casts."""
    li = _table(spark, sf_dir, "lineitem")
    text = stringify(li.withColumn(
        "l_is_final", F.when(F.col("l_linestatus") == "F", "TRUE").otherwise("false")))
    kinds = {"l_orderkey": "long", "l_linenumber": "long", "l_partkey": "long",
             "l_suppkey": "long", "l_quantity": "double", "l_extendedprice": "double",
             "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
             "l_linestatus": "string", "l_is_final": "bool"}
    contract = Contract("lineitem_text", tuple(Field(c, c, k) for c, k in kinds.items()),
                        "l_orderkey")
    return contract.typed(text)


@query("safe_int", """
SELECT l_orderkey, l_linenumber, CAST(round((l_quantity - 25) / 2) AS BIGINT) AS half_qty
FROM lineitem""")
def q_safe_int(spark, sf_dir):
    """Float text rounded half away from zero to a 64-bit integer."""
    li = _table(spark, sf_dir, "lineitem")
    text = li.select("l_orderkey", "l_linenumber", ((F.col("l_quantity") - 25) / 2).cast("string").alias("half_qty"))
    contract = Contract("half_quantities", (Field("half_qty", "half_qty", "safe_long"),), "half_qty")
    return contract.typed(text, "l_orderkey", "l_linenumber")


@query("parse_dates", """
SELECT o_orderkey, make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS ano_censo,
  CAST(o_orderdate AS DATE) AS inicio_ano, CAST(o_orderdate AS DATE) AS fim_ano
FROM orders""")
def q_parse_dates(spark, sf_dir):
    """P10, P11: '%Y' and '%d/%m/%Y' text, the latter both unpadded and padded."""
    o = _table(spark, sf_dir, "orders")
    text = o.select("o_orderkey", *[F.date_format("o_orderdate", pattern).alias(name) for name, pattern in
                                    (("ano_censo", "yyyy"), ("inicio_ano", "d/M/yyyy"), ("fim_ano", "dd/MM/yyyy"))])
    contract = Contract.from_text("order_dates", "year: anoCenso\ndmy: inicioAno fimAno", "ano_censo")
    return contract.typed(text, "o_orderkey")


# Fixed values of the analogue: order priorities, lowest first; '4-NOT SPECIFIED'
# is left out so it maps to NULL like an unknown label.
PRIORITY_LEVELS = ("5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT")


@query("ordinal_case", f"""
SELECT o_orderkey, o_orderpriority, {A.ordinal_sql("o_orderpriority", PRIORITY_LEVELS)} AS priority_rank
FROM orders""")
def q_ordinal_case(spark, sf_dir):
    """Ordinal CASE from one ordered label list; unknown -> NULL."""
    o = _table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderpriority",
                    ordinal("o_orderpriority", PRIORITY_LEVELS).alias("priority_rank"))


# =============================================================== layers

def _events_contract(events: DataFrame):
    return Contract.from_schema("events", events.schema, "event_id")


_EVENT_COLS = "event_id, ts, user_id, event_type, value, props"
_BATCH_1 = "2024-02-01 00:00:00"
_BATCH_2 = "2024-03-01 00:00:00"


def _ts(text: str):
    return datetime.fromisoformat(text)


@query("raw_append", f"""
SELECT {_EVENT_COLS}, TIMESTAMP '{_BATCH_1}' AS partition_time, DATE '2024-02-01' AS load_month
FROM events
UNION ALL
SELECT {_EVENT_COLS}, TIMESTAMP '{_BATCH_2}' AS partition_time, DATE '2024-03-01' AS load_month
FROM events""")
def q_raw_append(spark, sf_dir):
    """Two daily runs (land, copy to RAW, truncate); RAW keeps both."""
    events = _table(spark, sf_dir, "events")
    contract = _events_contract(events)
    root = workspace(spark, "raw_append")
    for batch in (_BATCH_1, _BATCH_2):
        layers.land(events, contract, f"{root}/land", F.lit(_ts(batch)))
        layers.refresh_raw(spark, contract, f"{root}/land", f"{root}/raw")
        layers.truncate(spark, f"{root}/land")
    return contract.typed(layers.read_raw(spark, contract, f"{root}/raw"), "partition_time", "load_month")


@query("latest_batch", f"""
SELECT {_EVENT_COLS}, date_trunc('day', ts) AS partition_time
FROM events
WHERE date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events)""")
def q_latest_batch(spark, sf_dir):
    """RAW holds one batch per day; TRUSTED keeps only the newest, typed."""
    events = _table(spark, sf_dir, "events")
    contract = _events_contract(events)
    root = workspace(spark, "latest_batch")
    # RAW holds the stamped text rows (the LAND step itself is covered by raw_append)
    stamped = layers.land_frame(events, contract, F.date_trunc("day", F.col("ts")))
    layers.append_raw(stamped, contract, f"{root}/raw")
    layers.refresh_trusted(spark, contract, f"{root}/raw", f"{root}/trusted")
    return layers.read_trusted(spark, contract, f"{root}/trusted").select(*contract.land_columns, "partition_time")


_NOW = "2024-02-01 12:00:00"
_SPLIT_DAY = "2024-01-16"


@query("stamp_nulls", f"""
SELECT event_id, event_type,
  CASE WHEN ts < TIMESTAMP '{_SPLIT_DAY} 00:00:00' THEN date_trunc('day', ts)
       ELSE TIMESTAMP '{_NOW}' - INTERVAL 3 HOUR END AS partition_time
FROM events""")
def q_stamp_nulls(spark, sf_dir):
    """Rows landed without a stamp get now - 3 h; stamped rows keep theirs."""
    events = _table(spark, sf_dir, "events")
    contract = _events_contract(events)
    root = workspace(spark, "stamp_nulls")
    early = F.col("ts") < F.lit(_SPLIT_DAY).cast("timestamp_ntz")
    layers.land(events.where(early), contract, f"{root}/land", F.date_trunc("day", F.col("ts")))
    layers.land(events.where(~early), contract, f"{root}/land", None)
    landed = layers.read_land(spark, contract, f"{root}/land")
    filled = layers.fill_missing_stamps(landed, layers.batch_instant(_ts(_NOW)))
    return filled.select(F.col("event_id").cast("bigint"), "event_type", "partition_time")


@query("dated_layout", """
SELECT o_orderkey, o_custkey, o_orderdate AS partition_time,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS load_month,
  strftime(o_orderdate, '%Y/%m/%d') AS archive_dir
FROM orders""")
def q_dated_layout(spark, sf_dir):
    """Orders stamped by order date, written month-partitioned and
    sorted by key, read back; the dated archive folder of each stamp."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    contract = Contract("orders", (Field("o_orderkey", "o_orderkey", "long"),
                                   Field("o_custkey", "o_custkey", "long")), "o_orderkey")
    root = workspace(spark, "dated_layout")
    stamped = o.select(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                       F.col("o_orderdate").cast("timestamp").alias("partition_time"))
    layers.append_raw(stamped, contract, f"{root}/raw")
    raw = layers.read_raw(spark, contract, f"{root}/raw")
    return contract.typed(raw, "partition_time", "load_month").withColumn(
        "archive_dir", layers.archive_path_column("partition_time"))


@query("archived_batch", f"""
SELECT {_EVENT_COLS}, TIMESTAMP '{_BATCH_1}' AS partition_time, '2024/02/01' AS archive_dir FROM events""")
def q_archived_batch(spark, sf_dir):
    """The stamped batch file under the dated archive folder, read back with the folder of each row's file."""
    events = _table(spark, sf_dir, "events")
    contract = _events_contract(events)
    stamped = layers.land_frame(events, contract, F.lit(_ts(_BATCH_1)))
    path = layers.archive_copy(stamped, workspace(spark, "archived_batch"), _ts(_BATCH_1), contract.name)
    rows = spark.read.schema(contract.land_schema()).parquet(path)
    folder = F.regexp_extract(F.input_file_name(), "/([0-9]{4}/[0-9]{2}/[0-9]{2})/events/[^/]*$", 1)
    return contract.typed(rows.withColumn("archive_dir", folder), "partition_time", "archive_dir")


@query("key_ranges", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS load_month, count(*) AS n_rows, CAST(0 AS BIGINT) AS overlaps
FROM orders GROUP BY 1""")
def q_key_ranges(spark, sf_dir):
    """K7, K8: files of a RAW month hold separate ranges of the clustering key (overlaps: files that begin before another one ends)."""
    o = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string"), F.col("o_orderdate").cast("timestamp").alias("partition_time"))
    contract = Contract("orders", (Field("o_orderkey", "o_orderkey", "long"),), "o_orderkey")
    root = workspace(spark, "key_ranges")
    layers.append_raw(o, contract, f"{root}/raw")
    files = (layers.read_raw(spark, contract, f"{root}/raw").groupBy("load_month", F.input_file_name().alias("file"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last")))
    # a window over one row per file of the month
    before = F.max("last").over(Window.partitionBy("load_month").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    return (files.withColumn("overlap", F.col("first") < before).groupBy("load_month")
            .agg(F.sum("n").alias("n_rows"), F.count_if("overlap").alias("overlaps")))


@query("land_truncate", """
SELECT count(*) AS rows_in_raw, CAST(0 AS BIGINT) AS rows_in_land FROM events""")
def q_land_truncate(spark, sf_dir):
    """K9: after the RAW copy, LAND is emptied but keeps its schema."""
    events = _table(spark, sf_dir, "events")
    contract = _events_contract(events)
    root = workspace(spark, "land_truncate")
    layers.land(events, contract, f"{root}/land", F.lit(_ts(_BATCH_1)))
    layers.refresh_raw(spark, contract, f"{root}/land", f"{root}/raw")
    layers.truncate(spark, f"{root}/land")
    land = layers.read_land(spark, contract, f"{root}/land")
    raw = layers.read_raw(spark, contract, f"{root}/raw")
    return raw.agg(F.count(F.lit(1)).alias("rows_in_raw")).select(
        "rows_in_raw", land.select(F.count(F.lit(1))).scalar().alias("rows_in_land"))


_MIXED_LOADS = [f"SELECT {_EVENT_COLS}, TIMESTAMP '{stamp}' AS partition_time, CAST({left} AS BIGINT) AS left_in_land FROM events WHERE event_id % 5 = {k}"
                for k, (stamp, left) in enumerate(((_BATCH_1, 0), (_BATCH_2, 0), (_BATCH_2, 0), (_BATCH_1, 0), (_BATCH_2, 0)))]


@query("raw_mixed", " UNION ALL ".join(_MIXED_LOADS))
def q_raw_mixed(spark, sf_dir):
    """K5, K9: the batch copy and the streamed copy into one RAW in every order (batch, late landing, stream, late landing,
    batch, a stop before the truncation, stream, truncation): each of five loads is in RAW once, and LAND is empty."""
    events = _table(spark, sf_dir, "events")
    contract = _events_contract(events)
    root = workspace(spark, "raw_mixed")
    land, raw = f"{root}/land", f"{root}/raw"

    def landing(k: int, stamp: str) -> None:
        layers.land(events.where(F.col("event_id") % 5 == k), contract, land, F.lit(_ts(stamp)))

    def stream() -> None:
        stream_land_to_raw(spark, contract, land, raw, f"{root}/_checkpoint")

    landing(0, _BATCH_1)
    copied = layers.refresh_raw(spark, contract, land, raw)
    landing(1, _BATCH_2)                                    # late: comes with the stream
    layers.truncate(spark, land, copied)
    stream()
    landing(2, _BATCH_2)                                    # late: comes with the next batch, the stream's load not again
    layers.refresh_raw(spark, contract, land, raw)
    landing(3, _BATCH_1)
    layers.refresh_raw(spark, contract, land, raw)          # stopped before its truncation
    landing(4, _BATCH_2)
    stream()                                                # copies the last load only
    layers.truncate(spark, land)
    left = layers.read_land(spark, contract, land).select(F.count(F.lit(1))).scalar()
    return contract.typed(layers.read_raw(spark, contract, raw), "partition_time").withColumn("left_in_land", left)


@query("empty_batch", f"""
SELECT 'all stamps NULL' AS input, 0 AS trusted_rows, 'event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string' AS columns,
  count(*) AS raw_rows FROM events
UNION ALL
SELECT 'empty LAND', 0, 'event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string', 0""")
def q_empty_batch(spark, sf_dir):
    """An empty LAND and a RAW whose stamps are all NULL give TRUSTED tables without rows that can be read."""
    events = _table(spark, sf_dir, "events")
    contract = _events_contract(events)
    out = []
    for name, rows in (("all stamps NULL", events), ("empty LAND", None)):
        root = workspace(spark, "empty_batch")
        if rows is not None:
            layers.land(rows, contract, f"{root}/land", None)
        layers.refresh_raw(spark, contract, f"{root}/land", f"{root}/raw")
        layers.refresh_trusted(spark, contract, f"{root}/raw", f"{root}/trusted")
        trusted = layers.read_trusted(spark, contract, f"{root}/trusted").select(contract.land_columns)
        raw = layers.read_raw(spark, contract, f"{root}/raw")
        out.append(trusted.agg(F.count(F.lit(1)).cast("int").alias("trusted_rows")).select(
            F.lit(name).alias("input"), "trusted_rows", F.lit(", ".join(f"{c} {t}" for c, t in trusted.dtypes)).alias("columns"),
            raw.select(F.count(F.lit(1))).scalar().alias("raw_rows")))
    return bag_union(out)


@query("raw_stream", f"""
SELECT {_EVENT_COLS}, TIMESTAMP '{_BATCH_1}' AS partition_time FROM events
UNION ALL
SELECT {_EVENT_COLS}, TIMESTAMP '{_BATCH_2}' AS partition_time FROM events""")
def q_raw_stream(spark, sf_dir):
    """K5 (safe form): LAND -> RAW as an availableNow file stream with a checkpoint;
    two landings, two incremental runs, each LAND file copied exactly once."""
    events = _table(spark, sf_dir, "events")
    contract = _events_contract(events)
    root = workspace(spark, "raw_stream")
    for batch in (_BATCH_1, _BATCH_2):
        layers.land(events, contract, f"{root}/land", F.lit(_ts(batch)))
        stream_land_to_raw(spark, contract, f"{root}/land", f"{root}/raw", f"{root}/_checkpoint")
    return contract.typed(layers.read_raw(spark, contract, f"{root}/raw"), "partition_time")


# =============================================================== payload sources

def _orders_payload_contract():
    return Contract.from_text("orders_payload", "long: orderKey custKey\nstring: orderStatus orderPriority",
                              "order_key")


@query("rename_stringify", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CAST(o_custkey AS VARCHAR) AS cust_key,
  o_orderstatus AS order_status, o_orderpriority AS order_priority
FROM orders""")
def q_rename_stringify(spark, sf_dir):
    """JSON objects with camelCase keys -> contract rename -> all text."""
    o = _table(spark, sf_dir, "orders")
    payloads = o.select(F.to_json(F.struct(
        F.col("o_orderkey").alias("orderKey"), F.col("o_custkey").alias("custKey"),
        F.col("o_orderstatus").alias("orderStatus"),
        F.col("o_orderpriority").alias("orderPriority"))).alias("value"))
    contract, root = _orders_payload_contract(), workspace(spark, "rename_stringify")
    audit = KeyAudit(contract)
    audit.watch(parse_objects(payloads, contract, audit)).write.parquet(root)
    audit.check()
    return spark.read.schema(contract.land_schema()).parquet(root).drop("partition_time")


@query("nested_explode", """
SELECT role AS secao, 'turn_' || CAST(turn AS VARCHAR) AS tema, m.entidade,
  CAST(CASE WHEN m.entidade = 'chars' THEN length(text) ELSE strlen(text) END AS VARCHAR) AS porcentagem,
  CAST(turn AS VARCHAR) AS escolas, role AS sigla_uf, CAST(conv_id AS VARCHAR) AS total_escolas,
  CAST(conv_id AS VARCHAR) AS ano,
  CASE WHEN role = 'assistant' THEN 'Privada' ELSE 'Pública' END AS tipo_escolas
FROM conversations, (VALUES ('chars'), ('octets')) m(entidade)""")
def q_nested_explode(spark, sf_dir):
    """Conversations nested as section (role) -> items (turns) -> values, then flattened.

    One payload per (conversation, dependency, block of 64 turns), so no
    payload grows with a long conversation.
    """
    c = _table(spark, sf_dir, "conversations")
    dep = F.when(F.col("role") == "assistant", 4).otherwise(5)
    values = F.array(*[F.struct(F.lit(name).alias("entidade"), size.cast("string").alias("value"),
                                F.col("turn").cast("string").alias("escolas"),
                                F.col("role").alias("slug"),
                                F.col("conv_id").cast("string").alias("qtd_escolas"))
                       for name, size in (("chars", F.length("text")),
                                          ("octets", F.octet_length("text")))])
    turns = c.select("conv_id", dep.alias("dep"), "role", F.floor(F.col("turn") / 64).alias("blk"),
                     F.struct(F.concat(F.lit("turn_"), F.col("turn").cast("string")).alias("label"),
                              values.alias("values")).alias("item"))
    sections = (turns.groupBy("conv_id", "dep", "blk", "role")
                .agg(F.collect_list("item").alias("items"))
                .select("conv_id", "dep", "blk",
                        F.struct(F.col("role").alias("section"), "items").alias("sec")))
    payloads = (sections.groupBy("conv_id", "dep", "blk")
                .agg(F.to_json(F.collect_list("sec")).alias("value"))
                .select(F.col("conv_id").alias("ano"), "dep", "value"))
    return flatten_infrastructure(payloads, "ano", "dep")


# Orders per envelope are capped by the order-key block, so a customer with
# very many orders spreads over many envelopes instead of one huge document.
_ENVELOPE_BLOCK = 64


@query("envelope_explode", """
SELECT o_custkey AS cidade, CAST(o_orderkey AS VARCHAR) AS cod FROM orders""")
def q_envelope_explode(spark, sf_dir):
    """[count, [ {cod} ]] envelopes (with [0, []] for customers without
    orders), count guard, explode."""
    o = _table(spark, sf_dir, "orders")
    c = _table(spark, sf_dir, "customer")
    full = (o.groupBy(F.col("o_custkey").alias("cidade"),
                      F.floor(F.col("o_orderkey") / _ENVELOPE_BLOCK).alias("_blk"))
            .agg(F.concat(F.lit("["), F.count(F.lit(1)).cast("string"), F.lit(","),
                          F.to_json(F.collect_list(F.struct(F.col("o_orderkey").alias("cod")))),
                          F.lit("]")).alias("value"))
            .select("cidade", "value"))
    has_orders = o.select(F.col("o_custkey").alias("c_custkey")).distinct()
    empty = (c.join(has_orders, "c_custkey", "left_anti")
             .select(F.col("c_custkey").alias("cidade"), F.lit("[0,[]]").alias("value")))
    return envelope_ids(bag_union([full, empty]), guard=True, keep=["cidade"])


@query("param_grid", """
SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS ano, d.dep,
  CASE WHEN d.dep = 4 THEN 'Privada' ELSE 'Pública' END AS tipo_escolas
FROM orders, (VALUES (4), (5)) d(dep)""")
def q_param_grid(spark, sf_dir):
    """The (year, dependency) request grid over the years present in orders."""
    years = _table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("bigint").alias("ano")).distinct()
    return parameter_grid(years, "ano")


# Fixed values of the analogue: balance shards with shared endpoints.
BALANCE_SHARDS = ((-1000, 0), (0, 2500), (2500, 5000), (5000, 7500), (7500, 10000))


@query("bag_union", " UNION ALL ".join(
    f"SELECT {i} AS shard, c_custkey, c_acctbal FROM customer WHERE c_acctbal BETWEEN {lo} AND {hi}"
    for i, (lo, hi) in enumerate(BALANCE_SHARDS)))
def q_bag_union(spark, sf_dir):
    """Overlapping range requests, bag union (no dedup), in one scan."""
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return shard_filter(c, "c_acctbal", BALANCE_SHARDS).select("shard", "c_custkey", "c_acctbal")


@query("id_lookup", """
SELECT o_orderkey, c_custkey, c_name, c_acctbal, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_id_lookup(spark, sf_dir):
    """One detail row per requested id (order's customer), repeats kept."""
    ids = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    details = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal",
                                                       "c_mktsegment")
    return id_lookup(ids, details, "c_custkey").select("o_orderkey", "c_custkey", "c_name",
                                                       "c_acctbal", "c_mktsegment")


# The analogue's "capital": customer 0, excluded from the city list.
_EXCLUDED_ID = "0000000"
_CITY_BLOCK = 1000


@query("prefix_antifilter", f"""
SELECT c_nationkey, lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS cidade FROM customer
WHERE lpad(CAST(c_custkey AS VARCHAR), 7, '0') <> '{_EXCLUDED_ID}'""")
def q_prefix_antifilter(spark, sf_dir):
    """JSON arrays of 'id - name' strings; first 7 chars; one id excluded."""
    c = _table(spark, sf_dir, "customer")
    label = F.concat(F.lpad(F.col("c_custkey").cast("string"), 7, "0"), F.lit(" - "), F.col("c_name"))
    payloads = (c.groupBy("c_nationkey", F.floor(F.col("c_custkey") / _CITY_BLOCK).alias("_blk"))
                .agg(F.to_json(F.collect_list(label)).alias("value")))
    return city_ids(payloads, exclude=_EXCLUDED_ID, keep=["c_nationkey"])


# =============================================================== README indicators

_FOCUS_STATE = "NATION_0"


@query("growth_5y", f"""
WITH y AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS ano, count(*) AS total,
         count(*) FILTER (WHERE n_name = '{_FOCUS_STATE}') AS focus
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1)
SELECT cur.ano, cur.focus AS focus_orders, cur.total AS total_orders,
  round((cur.focus - past.focus) / NULLIF(past.focus, 0) * 100, 6) AS focus_growth_pct,
  round((cur.total - past.total) / NULLIF(past.total, 0) * 100, 6) AS total_growth_pct
FROM y cur JOIN y past ON past.ano = cur.ano - 5""")
def q_growth_5y(spark, sf_dir):
    """X1 (our definition): 5-year growth of one state's order count against all states."""
    o = _table(spark, sf_dir, "orders")
    c = _table(spark, sf_dir, "customer")
    n = _table(spark, sf_dir, "nation")
    out = growth_vs_total(o, c, n, _FOCUS_STATE)
    return _round(out, ["focus_growth_pct", "total_growth_pct"])


@query("rank_groups", """
SELECT n_name AS SIGLA_UF, round(avg(c_acctbal), 6) AS media,
  CAST(rank() OVER (ORDER BY avg(c_acctbal) DESC) AS INTEGER) AS posicao
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def q_rank_groups(spark, sf_dir):
    """X2 (our definition): states ranked by mean score."""
    s = A.schools(spark, sf_dir).where(F.col("sigla_uf").isNotNull())
    return _round(rank_states(s, "sigla_uf", "enem_media_geral"), ["media"])


@query("vs_overall", """
SELECT c_custkey, c_acctbal, round((SELECT avg(c_acctbal) FROM customer), 6) AS media_geral,
  round(c_acctbal - (SELECT avg(c_acctbal) FROM customer), 6) AS diferenca
FROM customer""")
def q_vs_overall(spark, sf_dir):
    """X3 (our definition): each school's score against the overall mean."""
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return _round(against_overall(c, "c_acctbal"), ["media_geral", "diferenca"])
