"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laminar.session import workspace

SPACE = r"[\x20\x09-\x0D]+"      # what separates words; ``bytes.split()`` splits at the same six bytes
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text, NULL as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def word_array(text: Column) -> Column:
    """Words of a text with A-Z lower-cased (NULL: none), as SQL expressions."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, SPACE), lambda w: w != "")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder under the shared checkpoint root and read it back.

    The read-back has no lineage to recompute and survives lost executors.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, *drop: str) -> tuple[DataFrame, list[str]]:
    """(frame, columns): each row of ``df`` without ``drop`` as a struct ``_row`` with a 128-bit key of its whole content
    (``_k1``, ``_k2``; NULLs count, so rows share a key only if they are equal), and the struct's columns.

    Operators that number rows work on narrow rows with this key and fetch the contents at the end: no column
    name of the input can clash with theirs, and texts are not sorted with the numbers.
    """
    columns = [c for c in df.columns if c not in drop]
    kinds = dict(df.dtypes)
    values = [F.to_json(_plain(c)) if "map<" in kinds[c] else _plain(c) for c in columns]
    nulls = F.concat(F.lit(""), *[_plain(c).isNull().cast("string") for c in columns])
    return df.select(F.struct(*[_plain(c) for c in columns]).alias("_row"), F.xxhash64(nulls, *values).alias("_k1"),
                     F.xxhash64(F.lit(1), nulls, *values).alias("_k2")), columns


def _plain(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def field(name: str) -> Column:
    """A column of ``keyed``'s rows."""
    return F.col("_row.`" + name.replace("`", "``") + "`")


def fetched(rows: DataFrame, columns: list[str], narrow: DataFrame, *own: str, repeated: bool = True) -> DataFrame:
    """The contents of ``narrow``'s rows (``_k1``, ``_k2`` and their ``own`` columns) from ``keyed``'s ``rows``.

    ``repeated``: some rows may be equal; each content is then taken once (with partial aggregation), ``narrow`` having a
    row for each copy.
    """
    once = rows.groupBy("_k1", "_k2").agg(F.first("_row").alias("_row")) if repeated else rows
    return once.join(narrow, ["_k1", "_k2"]).select(*[field(c).alias(c) for c in columns], *[_plain(c) for c in own])


def running(df: DataFrame, group: list[str], order: list[str], amount: str, name: str) -> DataFrame:
    """``df`` with ``before``, the sum of ``amount`` over the earlier rows of the row's group (NULLs first), and the group's ``total``.

    Rows are dealt out in ranges of (group, order) and written once; sums per range and group give each range its
    offset, so a group that holds all rows is as many sorts as there are ranges. No two rows may tie.
    """
    by = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    dealt = materialise(df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), name)
    past = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    ranges = dealt.groupBy("_part", *group).agg(F.sum(amount).alias("_sum"))        # a row per range and group in it
    ranges = ranges.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_of_{c}") for c in group],
                           F.coalesce(F.sum("_sum").over(past), F.lit(0)).alias("_offset"), F.sum("_sum").over(W.partitionBy(*group)).alias("total"))
    inside = W.partitionBy("_part", *group).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(W.unboundedPreceding, -1)
    same = all_of([F.col("_part") == F.col("_p"), *[F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group]])
    return (dealt.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(ranges, same)
            .withColumn("before", F.col("_offset") + F.col("_inside"))
            .drop("_part", "_p", "_offset", "_inside", *[f"_of_{c}" for c in group]))


def any_of(conditions: list[Column]) -> Column:
    return functools.reduce(operator.or_, conditions)


def all_of(conditions: list[Column]) -> Column:
    return functools.reduce(operator.and_, conditions)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v), root being the smallest node reachable.

    Alternating large-star and small-star rounds: each round replaces a node's
    links by links to the smallest neighbour, so a round moves at most as many
    rows as there are links and nothing is gathered per component. The minima
    are partial aggregates and the joins are plain equi-joins, which adaptive
    execution splits when one node is the hub of a huge star. Rounds are
    written to the shared folder. No links: no rows.
    """
    def star(pairs: DataFrame, name: str) -> DataFrame:
        """Links every ``dst`` of a ``src`` to the smallest of them; pairs: (src, dst)."""
        return pairs.groupBy(F.col("src").alias("hub")).agg(F.min("dst").alias("low"))

    def signature(frame: DataFrame):
        row = frame.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        return tuple(row)

    links = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .filter("u <> v").distinct(), "links")
    seen = signature(links)
    while seen[0]:
        both = links.select(F.col("u").alias("src"), F.col("v").alias("dst")).unionByName(
            links.select(F.col("v").alias("src"), F.col("u").alias("dst")))
        low = star(both, "large").select("hub", F.least("hub", "low").alias("low"))
        large = (both.filter("dst > src").join(low, F.col("src") == F.col("hub"))
                 .select(F.col("dst").alias("u"), F.col("low").alias("v")).distinct())
        low = star(large.select(F.col("u").alias("src"), F.col("v").alias("dst")), "small")
        small = (large.join(low, F.col("u") == F.col("hub"))
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
                                           F.struct(F.col("u"), F.col("low").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        links = materialise(small, "links")
        now = signature(links)
        if now == seen:
            break
        seen = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
