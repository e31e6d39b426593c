"""Shards and slots by a Feistel permutation of global row numbers (the ``rows`` law).

Rows are numbered 0..N-1 in an order that depends on their values only (a hash, then the
key). A keyed Feistel network over the smallest
even power of two that holds N permutes the numbers; numbers that land outside [0, N)
walk the cycle until they are inside, so the result is a permutation of [0, N)
and any row's place can be computed alone:
shard = p mod shards, slot = p div shards. Shard sizes differ by one at most.

The numbering needs no global sort: narrow rows are counted in ranges of the order, and the ranges' counts give each its
offset. Equal rows are one narrow row with a count, however many they are. Texts are fetched by the rows' content
keys at the end and are not sorted.

Edge cases: NULL text counts no bytes and has the crc32 of the empty text; NULL
keys sort first; equal rows take neighbouring numbers in any order, which gives
the same rows out; an empty table gives no rows. Extra columns keep
their names, whatever they are; the operator's own columns replace columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import fetched, field, keyed, materialise, running, text_bytes

ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """SplitMix64 finaliser, the round function."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(numbers, total: int, seed: int = 0) -> np.ndarray:
    """The place of each number of [0, total) under the seeded permutation of [0, total)."""
    half = max(1, ((max(total, 2) - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [(seed * 1_000_003 + r * 0x632BE59BD9B4E019 + 1) % (1 << 64) for r in range(ROUNDS)]

    def once(x):
        left, right = x >> shift, x & mask
        for key in keys:
            left, right = right, left ^ (_mix(right, key) & mask)
        return (left << shift) | right

    with np.errstate(over="ignore"):
        out = once(np.asarray(numbers, np.uint64))
        walk = np.flatnonzero(out >= total)
        while walk.size:                      # the domain is under 4 x total, so few steps
            out[walk] = once(out[walk])
            walk = walk[out[walk] >= total]
    return out.astype(np.int64)


def shard(docs: DataFrame, shards: int = 8, seed: int = 0, key: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with row_number, shard and slot (existing columns of these names are replaced).

    Rows are numbered by a hash of the columns ``key``, then by their values; without ``key`` by a hash of their whole
    content. Rows that agree on all that are equal and may take each other's place.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    own = ("row_number", "shard", "slot")
    rows, columns = keyed(docs, *own)
    # narrow rows: the content key and the key columns, renamed
    names = [f"key{i}" for i in range(len(key))]
    text = F.concat_ws("|", *[F.coalesce(field(c).cast("string"), F.lit("")) for c in key]) if key else F.hex("_k1")
    bucket = F.substring(F.md5(text.cast("binary")), 1, 3) if key else F.hex("_k1")
    narrow = rows.select("_k1", "_k2", bucket.alias("bucket"), *[field(c).alias(n) for c, n in zip(key, names, strict=True)])
    classes = materialise(narrow.groupBy("_k1", "_k2", "bucket", *names).agg(F.count(F.lit(1)).alias("copies")), "rows")
    total, most = classes.agg(F.sum("copies"), F.max("copies")).first()
    total = total or 0

    @F.pandas_udf("bigint")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), total, seed))

    counted = running(classes, [], ["bucket", *names, "_k1", "_k2"], "copies", "numbers")
    each = (counted.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
            .withColumn("row_number", F.col("before") + F.col("nth")).withColumn("place", place("row_number")))
    placed = (each.withColumn("shard", F.pmod("place", F.lit(shards)).cast("int"))
              .withColumn("slot", F.floor(F.col("place") / shards).cast("bigint") if shards > 1 else F.col("place")))
    if set(key) == set(columns):            # the key is the whole row
        return placed.select(*[F.col(names[key.index(c)]).alias(c) for c in columns], *own)
    return fetched(rows, columns, placed.select("_k1", "_k2", *own), *own, repeated=(most or 0) > 1)


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32): bytes plus one, and the unsigned crc32 of the UTF-8 text."""
    data = text_bytes(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), (F.length(data) + 1).cast("bigint").alias("size"),
                       F.crc32(data).alias("text_crc32"))
