"""Benchmark decontamination by SimHash of item-sized windows (DataFrame operations only).

Words: runs of non-space characters, A-Z lower-cased. Shingles: five words in a
row, a shingle's weight is how often it occurs (an item of fewer words is one shingle).
For an item of n words the windows are n words long; a document of fewer words is one window as a whole.

1. Seeds. A window whose weighted similarity (sum of minima / sum of maxima of the weights) to an item
   is at least s shares at least ceil(2 s m / (1 + s)) of its m shingles with it (a whole document of k
   shingles: ceil(s (k + m) / (1 + s))). So texts that share no shingle cannot match. They are left out first, by the shingles on
   a grid so wide that every passing window has a shared one on it (``lossless_stride``). In the
   others every shingle shared with an item opens the item-sized window that begins with it (moving a window right to its first
   shared shingle, and left to the end of the text, loses none), but for windows with less than half of the shared shingles that passing takes.
2. SimHash of each opened window, and of each item, over (shingle, number of its occurrence) pairs: the share of
   common pairs is the weighted similarity, and a shingle that is repeated often counts as many pairs instead of outvoting all others.
3. Multi-index: fingerprints are cut into ``radius`` + 1 blocks; two within
   ``radius`` bits agree on a whole block, so the equi-join on (item, block, value) of windows and the
   items that opened them finds all of them. Their Hamming distance is then checked. No words go through this join.
4. The exact weighted-shingle similarity, on the words themselves, verifies the candidates.

The radius. At similarity 0.8 the cosine of two windows of equal size is 8/9, which makes an expected 9.7 differing bits with a deviation
of 2.9 (a whole shorter document: 9.4); the default of 22 lies 4.4 deviations above, so of windows that just pass about 4 in a million are beyond it, and
more similar ones are closer. Unrelated windows differ in 32 bits, deviation 4.

The items are broadcast only after a count of their shingles (``BROADCAST_ROWS``); beyond
that the same plan runs as a shuffle join, which adaptive execution splits on hot shingles.

Edge cases: NULL and empty texts have no words and no matches; items without words match nothing;
repeated documents (same id and text) and repeated items give one row; an id that is NULL is
kept as NULL; no documents or no items: no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import field, keyed, materialise, word_array

SHINGLE = 5
RADIUS = 22
SEED_SHARE = 0.5            # of the shared shingles that a passing window must have; under 1 it loses none
BROADCAST_ROWS = 200_000


def _hash_at(words: Column, i: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(width)])


def _shingles(words: Column, width: int, stride: int = 1) -> Column:
    """Hashes of the runs of ``width`` words that begin at every ``stride``-th word (none if there are fewer words)."""
    return F.when(F.size(words) >= width,
                  F.transform(F.sequence(F.lit(0), F.size(words) - width, F.lit(stride)), lambda i: _hash_at(words, i, width))) \
        .otherwise(F.array().cast("array<bigint>"))


def _shingle_texts(words: Column, width: Column) -> Column:
    """The shingles as texts, for the exact check."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: F.array_join(F.slice(words, i, width), " "))


def _least(m: int, similarity: float, other: int | None = None) -> int:
    """Shingles that two sets of m (or of m and ``other``) have to share to be at least so similar."""
    return math.ceil(similarity / (1 + similarity) * (m + (m if other is None else other)) - 1e-6)


def lossless_stride(sizes: list[int], similarity: float, most: int = 8) -> int:
    """The widest stride at which every window that can pass still has a shared shingle on the grid.

    A window of m shingles has at least floor(m / stride) of them on the grid, of which at most
    m - least(m) are not shared. The grid of a document that is one window begins with it, so of k shingles
    ceil(k / stride) are on it.
    """
    def whole(d: int, m: int) -> bool:
        return all(-(-k // d) - (k - _least(k, similarity, m)) >= 1 for k in range(max(1, math.ceil(similarity * m - 1e-6)), m))
    return max(d for d in range(1, most + 1) if d == 1 or all(m // d - (m - _least(m, similarity)) >= 1 and whole(d, m) for m in sizes))


def _simhash(frame: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, m, fp) from one row per shingle hash ``h`` (repeats count): bit set in over half of the pairs (shingle, occurrence).

    Two bit counters share a long, which holds windows of up to two billion shingles.
    """
    pairs = (frame.groupBy(*keys, "h").agg(F.count(F.lit(1)).alias("times"))
             .select(*keys, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("nth"), "h")
             .withColumn("h", F.xxhash64("h", "nth")))
    sums = [F.expr(f"sum(shiftrightunsigned(h, {j}) & {1 | 1 << 32}L)").alias(f"s{j}") for j in range(32)]
    counted = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"), *sums)
    bits = [f"if(2 * (shiftrightunsigned(s{j % 32}, {32 * (j // 32)}) & 4294967295L) > m, shiftleft(1L, {j}), 0L)" for j in range(64)]
    while len(bits) > 1:                            # a balanced tree of ORs
        bits = [f"({a} | {b})" for a, b in zip(bits[::2], bits[1::2], strict=True)]
    return counted.select(*keys, F.expr(bits[0]).alias("fp"))


def _block_values(fp: str, radius: int) -> list[str]:
    """SQL of each of the radius + 1 blocks of a fingerprint."""
    if radius == 0:
        return [fp]
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [f"shiftrightunsigned({fp}, {a}) & {(1 << (b - a)) - 1}L" for a, b in zip(edges, edges[1:], strict=False)]


def _blocks(radius: int) -> Column:
    """Rows (block, value) of the fingerprint in ``fp``."""
    return F.expr("inline(array(" + ", ".join(f"struct({k} as block, {v} as value)" for k, v in enumerate(_block_values("fp", radius))) + "))")


def _first_equal_block(radius: int) -> Column:
    same = zip(_block_values("fp", radius), _block_values("item_fp", radius), strict=True)
    return F.expr("case " + " ".join(f"when {a} = {b} then {k}" for k, (a, b) in enumerate(same)) + " end")


def benchmark_matches(docs: DataFrame, items: DataFrame, similarity: float = 0.8, radius: int = RADIUS,
                      broadcast_rows: int = BROADCAST_ROWS, by: tuple[str, ...] = ("doc_id", "item_id")) -> DataFrame:
    """(doc_id, item_id, similarity, hamming, start, windows): each document and item that match.

    ``by`` may name ``text_hash`` too, which keeps the texts of one id apart.

    The most similar window is named by its first word (``start``, from 0; ties: fewest
    differing bits, then the earliest), ``windows`` counts the windows that matched.
    """
    if not 0 < similarity <= 1 or not 0 <= radius < 63:
        raise ValueError("similarity must be in (0, 1] and radius in [0, 62]")
    item_words = (items.select("item_id", word_array(F.col("text")).alias("item_words"))
                  .withColumn("n", F.size("item_words")).filter("n > 0")
                  .withColumn("width", F.least(F.lit(SHINGLE), F.col("n"))))
    # (width, shingles) of the items: as many rows as there are different item sizes
    shapes = item_words.select("width", (F.col("n") - F.col("width") + 1).alias("m")).distinct().collect()
    widths = sorted({r.width for r in shapes}) or [SHINGLE]
    stride = lossless_stride([r.m for r in shapes], similarity)
    item_hashes = F.coalesce(*[F.when(F.col("width") == k, _shingles(F.col("item_words"), k)) for k in widths])
    item_shingles = item_words.select("item_id", "n", "width", F.explode(item_hashes).alias("h"))
    small = item_shingles.count() <= broadcast_rows
    side = F.broadcast if small else (lambda df: df)

    # 1. texts with a shared shingle on the grid; of these all hits, and the windows that the hits open
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    grid = F.concat(*[_shingles(F.col("words"), k, stride) for k in widths])
    found = (texts.select("doc_id", "text_hash", word_array(F.col("text")).alias("words"))
             .select("doc_id", "text_hash", F.explode(grid).alias("h"))
             .join(side(item_shingles.select(F.col("h").alias("item_h")).distinct()), F.col("h") == F.col("item_h"))
             .select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).distinct())
    near = materialise(texts.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")), "left_semi")
                       .select("doc_id", "text_hash", word_array(F.col("text")).alias("words")), "seeds")
    hashes = F.concat(*[F.transform(_shingles(F.col("words"), k), lambda h, i: F.struct(i.alias("at"), h.alias("h"))) for k in widths])
    seeds = side(item_shingles.distinct().withColumnRenamed("n", "item_n"))
    hits = (near.select("doc_id", "text_hash", F.size("words").alias("length"), F.explode(hashes).alias("s"))
            .select("doc_id", "text_hash", "length", "s.at", "s.h")
            .join(seeds, "h").select("doc_id", "text_hash", "length", "at", "item_id", "item_n", "width")
            .distinct())
    n = F.least("length", "item_n")                               # words of the window
    key = ["doc_id", "text_hash", "start", "n", "opener", "opener_n", "width"]
    # positions in units of m, so that one literal frame covers the m shingles of a window whatever the item's size
    m = F.col("item_n") - F.col("width") + 1
    covered = F.expr("count(1) over (partition by doc_id, text_hash, item_id, item_n "
                     "order by at / m range between current row and 0.9999999D following)")
    least = F.lit(similarity / (1 + similarity)) * (m + n - F.col("width") + 1)
    windows = (hits.withColumn("m", m).withColumn("covered", covered).filter(F.col("covered") >= least * SEED_SHARE)
               .select("doc_id", "text_hash", F.least("at", F.col("length") - n).alias("start"), n.alias("n"),
                       F.col("item_id").alias("opener"), F.col("item_n").alias("opener_n"), "width").distinct())

    # 2. fingerprints of windows and items; both are few and written, so the steps below start from tables
    text = [F.col("doc_id").eqNullSafe(F.col("d")), F.col("text_hash") == F.col("t")]
    named = near.withColumnRenamed("doc_id", "d").withColumnRenamed("text_hash", "t")
    cut = F.slice("words", F.col("start") + 1, F.col("n"))
    # windows of one place and size have one fingerprint, whichever items opened them
    places = windows.select("doc_id", "text_hash", "start", "n", "width").distinct()
    window_hashes = F.coalesce(*[F.when(F.col("width") == k, _shingles(F.col("cut"), k)) for k in widths])
    place = ["doc_id", "text_hash", "start", "n", "width"]
    prints = _simhash(places.join(named, text).select(*place, cut.alias("cut")).select(*place, F.explode(window_hashes).alias("h")), place)
    again = prints.select(*[F.col(c).alias(f"p_{c}") for c in place], "fp")
    prints = materialise(windows.join(again, [F.col(c).eqNullSafe(F.col(f"p_{c}")) for c in place]).select(*key, "fp"), "windows")
    item_prints = materialise(_simhash(item_shingles, ["item_id", "n"]).select("item_id", F.col("n").alias("item_n"), F.col("fp").alias("item_fp")), "items")

    # 3. multi-index Hamming join
    left = prints.select("*", _blocks(radius))
    right = item_prints.withColumn("fp", F.col("item_fp")).select("item_id", "item_n", "item_fp", _blocks(radius)) \
        .withColumnRenamed("block", "item_block").withColumnRenamed("value", "item_value")
    candidates = (left.join(side(right), F.expr("opener <=> item_id and opener_n = item_n and block = item_block and value = item_value"))
                  .withColumn("hamming", F.expr("bit_count(fp ^ item_fp)")).filter(F.col("hamming") <= radius)
                  # of the blocks on which they agree, the first one speaks for the pair
                  .filter(F.col("block") == _first_equal_block(radius))
                  .select("doc_id", "text_hash", "item_id", "item_n", "start", "n", "width", "hamming"))
    its_words = item_words.select(F.col("item_id").alias("i"), F.col("n").alias("i_n"), "item_words")
    candidates = (candidates.join(named, text).withColumn("words", _shingle_texts(cut, F.col("width")))
                  .join(side(its_words), F.expr("item_id <=> i and item_n = i_n"))
                  .withColumn("item_words", _shingle_texts(F.col("item_words"), F.col("width"))))

    # 4. exact check: weights of each shingle on either side
    pair = ["doc_id", "text_hash", "item_id", "item_n", "start", "hamming"]
    weights = (candidates.select(*pair, F.expr("explode(concat(transform(words, s -> struct(s as s, 1 as mine, 0 as theirs)), "
                                               "transform(item_words, s -> struct(s as s, 0 as mine, 1 as theirs)))) as w"))
               .groupBy(*pair, "w.s").agg(F.sum("w.mine").alias("mine"), F.sum("w.theirs").alias("theirs")))
    best = F.struct((-F.col("similarity")).alias("less"), "hamming", "start")
    return (weights.groupBy(*pair).agg((F.sum(F.least("mine", "theirs")) / F.sum(F.greatest("mine", "theirs"))).alias("similarity"))
            .filter(F.col("similarity") >= similarity).groupBy(*by)
            .agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("windows"))
            .select(*by, (-F.col("best.less")).alias("similarity"), "best.hamming", "best.start", "windows"))


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without those that match an item. Rows count by id and text: of rows that share an id, or have none, only those
    whose own text matches go."""
    found = benchmark_matches(docs, items, by=("doc_id", "text_hash"), **options)
    rows, columns = keyed(docs)
    leaks = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = field("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(field("text")) == F.col("_hash"))
    return rows.join(leaks, same, "left_anti").select(*[field(c).alias(c) for c in columns])
