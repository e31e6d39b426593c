"""SimHash near-duplicates with pivot distance tables.

Fingerprints: 64-bit SimHash of word shingles (XXH64, seed 42). Two
fingerprints are linked when they differ in at most ``max_distance`` bits.

Finding the links. Every distinct fingerprint gets a row of the pivot table:
its Hamming distances to ``PIVOTS`` reference fingerprints. Two fingerprints
within distance 2r share a point at distance <= r from both, so each
fingerprint is dealt out under the points of its ball of radius r = max_distance / 2
(65 points for distance 2). A point's cell is its own vector of distances to the
first four pivots. Inside a cell the rows are sorted by point and only
*neighbours in that order* become candidate pairs:

* candidates whose largest difference of pivot distances exceeds
  ``max_distance`` are discarded (triangle inequality, so no link is lost),
* the survivors are verified by their exact Hamming distance.

All fingerprints under one point are mutually within ``max_distance``, hence
chaining neighbours keeps each such set connected: every link between two texts is
kept as a path, with at most 65 candidates per distinct fingerprint, however
large a group of near copies is. Nothing is paired within a group.

Edge cases: NULL and empty texts have fingerprint zero and link like any other;
repeated rows give one output row each; the component of rows whose doc_id is
all NULL is NULL; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laminar.llm.common import connected_components, field, keyed, materialise, text_bytes

PIVOTS = [value - (1 << 63) for value in map(random.Random(20).getrandbits, [64] * 8)]
CELL_PIVOTS = 4


def simhash_of(words: list[bytes], shingle: int) -> int:
    """Unsigned fingerprint of one word list (reference form, also used by tests)."""
    n = len(words)
    if not n:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, n - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def _batch_fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    """Signed 64-bit fingerprints of a batch of texts."""
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        if len(words) <= shingle:
            spans = [(0, len(joined))]
        else:
            starts = np.concatenate(([0], ends[:-shingle]))
            spans = zip(starts.tolist(), (ends[shingle - 1:] - 1).tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], np.uint64)
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 16):       # bounded memory for very long texts
            part = hashes[at:at + (1 << 16)]
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        bits = (2 * counts > len(hashes)).astype(np.uint8)
        out[k] = np.packbits(bits, bitorder="little").view(np.int64)[0]
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) per row of ``docs``; fp is the signed view of the 64 bits."""
    def run(batches):
        for batch in batches:
            fp = _batch_fingerprints(batch.column(1).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), text_bytes(F.col(text_col)).alias("t"))
            .mapInArrow(run, f"doc_id {kind}, fp bigint"))


def _distance(a: Column, b) -> Column:
    return F.bit_count(a.bitwiseXOR(b if isinstance(b, Column) else F.lit(b)))


def _ball_masks(radius: int) -> list[int]:
    masks = []
    for r in range(radius + 1):
        for bits in itertools.combinations(range(64), r):
            mask = sum(1 << b for b in bits)
            masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def pivot_table(distinct_fps: DataFrame) -> DataFrame:
    """(fp, pivots): the distances to all pivots, eight to a long, one byte each."""
    packed = F.lit(0).cast("bigint")
    for i, pivot in enumerate(PIVOTS):
        packed = packed.bitwiseOR(F.shiftleft(_distance(F.col("fp"), pivot).cast("bigint"), 8 * i))
    return distinct_fps.withColumn("pivots", packed)


def links(distinct_fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """(u, v): verified links that connect exactly what links of <= max_distance bits connect."""
    if max_distance % 2 or not 0 <= max_distance <= 4:
        raise ValueError("max_distance must be 0, 2 or 4: a ball of half the distance is dealt out")
    masks = F.array(*[F.lit(m).cast("bigint") for m in _ball_masks(max_distance // 2)])
    dealt = (pivot_table(distinct_fps)
             .select("fp", "pivots", F.explode(masks).alias("mask"))
             .select("fp", "pivots", F.col("fp").bitwiseXOR(F.col("mask")).alias("point")))
    cell = F.lit(0)
    for pivot in PIVOTS[:CELL_PIVOTS]:
        cell = cell * 65 + _distance(F.col("point"), pivot)
    order = W.partitionBy("cell").orderBy("point", "fp")
    pairs = (dealt.withColumn("cell", cell)
             .select("fp", "pivots", F.lag("fp").over(order).alias("other"), F.lag("pivots").over(order).alias("other_pivots")))
    def byte(c, i):
        return F.shiftright(F.col(c), 8 * i).bitwiseAND(F.lit(255))
    gap = F.greatest(*[F.abs(byte("pivots", i) - byte("other_pivots", i)) for i in range(len(PIVOTS))])
    return (pairs.filter("other is not null and other <> fp").filter(gap <= max_distance)
            .filter(_distance(F.col("fp"), F.col("other")) <= max_distance)
            .select(F.col("fp").alias("u"), F.col("other").alias("v")).distinct())


def _rooted(marked: DataFrame, max_distance: int) -> DataFrame:
    """(fp, root) for each fingerprint of ``marked``."""
    distinct = marked.select("fp").distinct()
    roots = materialise(connected_components(links(distinct, max_distance)), "roots")
    return materialise(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                       .select("fp", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``."""
    marked = materialise(fingerprints(docs, shingle, id_col, text_col), "simhash")
    rooted = _rooted(marked, max_distance).join(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(firsts, "root").select("fp", "component_id")
    return marked.join(named, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_distance: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the near-duplicates: one row of each component stays, that with the smallest id (NULL last; then by
    a hash of the whole row).

    Rows count by their content, not by their ids: different texts under one id, or without an id, are
    different documents, and all are compared. Of equal rows one stays.
    """
    rows, columns = keyed(docs)
    named = rows.select("_k1", "_k2", field(id_col).alias("id"), field(text_col).alias("text"))
    # the fingerprint step carries the key of the row as its id
    prints = fingerprints(named.withColumn("row", F.concat_ws(",", "_k1", "_k2")), shingle, "row", "text")
    key = F.split("doc_id", ",")
    marked = materialise(prints.select(key[0].cast("bigint").alias("_k1"), key[1].cast("bigint").alias("_k2"), "fp").distinct(), "simhash")
    ids = named.select("_k1", "_k2", "id").distinct()
    first = F.struct(F.col("id").isNull().alias("none"), "id", "_k1", "_k2")
    stay = (marked.join(_rooted(marked, max_distance), "fp").join(ids, ["_k1", "_k2"])
            .groupBy("root").agg(F.min(first).alias("first")).select("first._k1", "first._k2"))
    kept = rows.join(stay, ["_k1", "_k2"], "left_semi")
    one = kept.groupBy("_k1", "_k2").agg(F.first("_row").alias("_row"))
    return one.select(*[field(c).alias(c) for c in columns])
