"""Readers for the saved API payloads.

Payloads are JSON text: one document per file (``wholetext``) or one per
line. Every reader takes a DataFrame with a text column ``value`` (from
``read_payloads`` or built with ``to_json``) and returns rows; all parsing is
``from_json`` / ``parse_json`` + ``variant_get`` / ``explode``, so the work is spread over
the payload files and never passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laminar.functions import id_prefix, rename_columns, request_school_type, stringify
from laminar.functions.sqltext import literal
from laminar.plans.contracts import Contract, ContractError

# The capital's city id, fetched through score shards instead
# of the city-wide search, and the width of a city id.
CAPITAL_CITY_ID = "3550308"
CITY_ID_WIDTH = 7

# The score shards of the capital's search (shared endpoints).
CAPITAL_SCORE_SHARDS = ((1, 507), (507, 530), (530, 551), (551, 566), (566, 585),
                        (585, 627), (627, 999))

# The state codes whose statistics are requested, in request order.
STATE_CODES = ("SP", "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG",
               "PA", "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SE", "TO")

# Infrastructure request grid.
INFRA_YEARS = tuple(range(2012, 2024))
INFRA_DEPENDENCIES = (4, 5)

INFRA_VALUE = T.StructType([T.StructField(n, T.StringType())
                            for n in ("entidade", "value", "escolas", "slug", "qtd_escolas")])
INFRA_ITEM = T.StructType([T.StructField("label", T.StringType()),
                           T.StructField("values", T.ArrayType(INFRA_VALUE))])
INFRA_SECTION = T.StructType([T.StructField("section", T.StringType()),
                              T.StructField("items", T.ArrayType(INFRA_ITEM))])
INFRA_PAYLOAD = T.ArrayType(INFRA_SECTION)
FAIL = {"mode": "FAILFAST"}     # a document that does not decode fails the job, as in the reference


def read_payloads(spark: SparkSession, path: str, whole_files: bool = True, keys: str = "") -> DataFrame:
    """Payload text, one row per file (or per line when ``whole_files`` is False), with the request keys of the folder
    names (``keys``: their schema; nothing is inferred, so an id keeps its leading zeros)."""
    return spark.read.schema("value string" + (f", {keys}" if keys else "")).text(path, wholetext=whole_files)


def required(df: DataFrame, holds: Column, *message: Column | str) -> DataFrame:
    """``df``, failing with the message when a row does not satisfy ``holds``.

    The check is a filter, which the optimizer keeps whatever columns are read later (a check on a column goes with the
    column). It counts as nondeterministic through the partition number, so later filters are not moved below it: one that
    rejects NULLs would otherwise turn the outer join under the check into an inner one, and the row to fail on would be gone.
    """
    text = F.concat(*[F.lit(m) if isinstance(m, str) else F.coalesce(m.cast("string"), F.lit("NULL")) for m in message])
    checked = F.when(holds, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
    return df.where(checked & (F.spark_partition_id() >= 0))


def city_ids(payloads: DataFrame, exclude: str = CAPITAL_CITY_ID,
             width: int = CITY_ID_WIDTH, keep: Sequence[str] = ()) -> DataFrame:
    """Explode a JSON array of 'id - name' strings; id = first 7 chars; drop ``exclude``."""
    names = payloads.select(*keep, F.explode(F.from_json("value", "array<string>", FAIL)).alias("_s"))
    ids = names.select(*keep, id_prefix("_s", width).alias("cidade"))
    return ids.where(F.col("cidade") != exclude)


def envelope_ids(payloads: DataFrame, id_field: str = "cod", guard: bool = True,
                 keep: Sequence[str] = ()) -> DataFrame:
    """``[count, [ {cod, ...}, ... ]]`` -> one row per object's id.

    The mixed-type envelope is parsed once into a VARIANT and both parts are
    read from it with typed paths. Malformed JSON fails, as decoding the
    response does in the reference. With ``guard`` only envelopes whose
    count is not 0 are read (S3); an empty or null list yields no rows
    either way. Any other shape fails.
    """
    parsed = payloads.select(*keep, F.parse_json("value").alias("_doc")).select(
        *keep, F.try_variant_get("_doc", "$", "array<variant>").alias("_parts"))
    # an error object, or anything but [count, items], stops the run, as indexing the response does
    parsed = required(parsed, F.size("_parts") >= 2, "not a [count, items] payload").select(
        *keep, F.variant_get(F.get("_parts", F.lit(0)), "$", "bigint").alias("_n"),
        F.variant_get(F.get("_parts", F.lit(1)), "$", f"array<struct<{id_field}:string>>").alias("_items"))
    if guard:
        parsed = parsed.where(F.col("_n") != 0)
    return parsed.select(*keep, F.explode("_items").alias("_o")).select(
        *keep, F.col(f"_o.{id_field}").alias(id_field))


def bag_union(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def shard_filter(df: DataFrame, score: str = "enem_media_geral",
                 shards: Sequence[tuple[float, float]] = CAPITAL_SCORE_SHARDS,
                 shard_col: str = "shard") -> DataFrame:
    """F7 + S4 in one scan: one output row per shard whose [lo, hi] holds the score.

    Equal to the UNION ALL of one inclusive range filter per shard (a score
    on a shared endpoint appears twice), but reads the input once instead
    of once per shard.
    """
    bounds = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
                       for i, (lo, hi) in enumerate(shards)])
    s = F.col(score)
    hits = F.filter(bounds, lambda b: s.between(b["lo"], b["hi"]))
    return (df.withColumn("_hit", F.explode(hits))
              .withColumn(shard_col, F.col("_hit.i")).drop("_hit"))


def id_lookup(ids: DataFrame, details: DataFrame, key: str, required_ids: bool = False) -> DataFrame:
    """One detail row per requested id, repeats kept.

    A shuffle join on the key; AQE splits a hot id's partition. With
    ``required_ids`` an id without a detail fails the job, naming the id,
    whatever columns are read; otherwise such ids have no row.
    """
    if not required_ids:
        return ids.join(details, key, "inner")
    joined = ids.join(details.withColumn("_found", F.lit(True)), key, "left")
    return required(joined, F.col("_found"), f"no payload for {key} ", F.col(key)).drop("_found")


def answered(requests: DataFrame, payloads: DataFrame, *keys: str) -> DataFrame:
    """The payloads of a driving request table; a request without a payload fails, and so does a payload
    that nobody requested. Both sides are small beside the payloads' contents, the join is on the request keys."""
    asked = requests.select(*keys).distinct().withColumn("_asked", F.lit(True))
    joined = payloads.withColumn("_found", F.lit(True)).join(asked, list(keys), "full_outer")
    name = [x for k in keys for x in (f" {k}=", F.col(k))]
    joined = required(joined, F.col("_found"), "no payload for the request", *name)
    return required(joined, F.col("_asked"), "payload outside the requests:", *name).drop("_asked", "_found")


class KeyAudit:
    """Strict payload keys (S6), judged while the objects are read for the landing write: no pass of its own.

    A key outside the contract fails in the task that meets it. Keys that no object holds are known when the write is
    done: each object carries the bitmap of its keys to the write, where an ``Observation`` ors the bitmaps.
    """

    WORD = 62

    def __init__(self, contract: Contract):
        self.contract, self.observation = contract, Observation()
        self.keys = [f.source for f in contract.fields]
        self.columns = [f"_keys{i}" for i in range(-(-len(self.keys) // self.WORD))]

    def mark(self, payloads: DataFrame) -> DataFrame:
        """Check each object (column ``value``) and add its bitmap in ``columns``."""
        names = "array(" + ", ".join(literal(k) for k in self.keys) + ")"
        held = payloads.withColumn("_held", F.json_object_keys("value"))
        held = required(held, F.expr(f"size(array_except(_held, {names})) = 0"), f"{self.contract.name}: keys outside the contract ",
                        F.expr(f"array_join(array_except(_held, {names}), ', ')"))
        held = held.withColumn("_absent", F.expr(f"array_except({names}, _held)"))
        words = {}
        for i, name in enumerate(self.columns):
            bits = ", ".join(f"{literal(k)}, {1 << j}L" for j, k in enumerate(self.keys[i * self.WORD:(i + 1) * self.WORD]))
            # the usual object lacks nothing: all bits, without going through its keys
            words[name] = F.expr(f"CASE WHEN size(_absent) = 0 THEN -1L ELSE aggregate(_absent, -1L, "
                                 f"(acc, k) -> acc & ~coalesce(map({bits})[k], 0L)) END")
        return held.withColumns(words).drop("_held", "_absent")

    def watch(self, df: DataFrame) -> DataFrame:
        """``df`` without the bitmaps, which are or-ed when it is written."""
        return df.observe(self.observation, *[F.expr(f"bit_or({c})").alias(c) for c in self.columns]).drop(*self.columns)

    def check(self) -> None:
        """After the write: fail listing the contract keys that were in no object (nothing to say of no objects)."""
        words = list(self.observation.get.values())
        if None in words:
            return
        missing = [k for i, k in enumerate(self.keys) if not words[i // self.WORD] >> i % self.WORD & 1]
        if missing:
            raise ContractError(f"{self.contract.name}: keys missing from every object {sorted(missing)}")


def parse_objects(payloads: DataFrame, contract: Contract, audit: KeyAudit | None = None) -> DataFrame:
    """Flat JSON objects -> contract keys as text, renamed to LAND names.

    With ``audit`` the keys are strict: the result carries the audit's ``columns``; give what is written to its ``watch``,
    and call its ``check`` after the write.
    """
    marks = [] if audit is None else audit.columns
    payloads = payloads if audit is None else audit.mark(payloads)
    parsed = payloads.select(F.from_json("value", contract.source_schema(), FAIL).alias("_o"), *marks).select("_o.*", *marks)
    return stringify(rename_columns(parsed, contract.rename_map), keep=tuple(marks))


def read_objects(spark: SparkSession, path: str, contract: Contract, audit: KeyAudit | None = None) -> DataFrame:
    """S6/S7 from files of JSON objects, one per line, schema from the contract."""
    return parse_objects(read_payloads(spark, path, whole_files=False), contract, audit)


def flatten_infrastructure(payloads: DataFrame, year: str = "ano", dependency: str = "dep") -> DataFrame:
    """Sections -> items -> values, plus the request parameters.

    ``payloads`` has the text ``value`` and the request's year and dependency.
    Empty lists produce no rows; anything but a list of sections with items with values fails.
    """
    lists = required(payloads, F.json_array_length("value").isNotNull(), "not a list of sections: ano=", F.col(year),
                     " dep=", F.col(dependency))
    sections = lists.select(F.col(year).alias("_ano"), F.col(dependency).alias("_dep"),
                            F.explode(F.from_json("value", INFRA_PAYLOAD, FAIL)).alias("_s"))
    items = required(sections, F.col("_s.items").isNotNull(), "a section without items: ", F.col("_s.section")).select(
        "_ano", "_dep", F.col("_s.section").alias("secao"), F.explode("_s.items").alias("_i"))
    values = required(items, F.col("_i.values").isNotNull(), "an item without values: ", F.col("_i.label")).select("_ano", "_dep", "secao", F.col("_i.label").alias("tema"),
                          F.explode("_i.values").alias("_v"))
    return values.select(
        F.col("secao"), F.col("tema"), F.col("_v.entidade").alias("entidade"),
        F.col("_v.value").alias("porcentagem"), F.col("_v.escolas").alias("escolas"),
        F.col("_v.slug").alias("sigla_uf"), F.col("_v.qtd_escolas").alias("total_escolas"),
        F.col("_ano").cast("string").alias("ano"),
        request_school_type(F.col("_dep")).alias("tipo_escolas"))


def parameter_grid(years: DataFrame, year: str = "ano",
                   dependencies: Sequence[int] = INFRA_DEPENDENCIES) -> DataFrame:
    """Every year with every dependency, and the school-type label.

    The dependency list is a literal array exploded per year, not a join.
    """
    deps = F.array(*[F.lit(d) for d in dependencies])
    grid = years.select(F.col(year), F.explode(deps).alias("dep"))
    return grid.withColumn("tipo_escolas", request_school_type("dep"))


def literal_grid(spark: SparkSession, years: Sequence[int] = INFRA_YEARS,
                 dependencies: Sequence[int] = INFRA_DEPENDENCIES) -> DataFrame:
    """The reference's fixed 12 x 2 request grid: the table that drives the infrastructure landing."""
    years_df = spark.createDataFrame([(y,) for y in years], "ano int")
    return parameter_grid(years_df, "ano", dependencies)


def literal_states(spark: SparkSession, states: Sequence[str] = STATE_CODES) -> DataFrame:
    """The requested states: the table that drives the statistics landing."""
    return spark.createDataFrame([(s,) for s in states], "nome_local string")
