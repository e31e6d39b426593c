"""Divergence between the sources of each language, over cells of a three-dimensional cube.

Every (language, source) group has a smoothed integer distribution p over its language's kept terms
(those in at least ``min_docs`` of its documents); the divergence of two groups is the sum over all kept terms of
floor((p - q)^2 / (p + q)). All arithmetic is on integers.

Cube. A language's groups are dealt into blocks, and so are its terms. A task owns one cell (group block, group
block, term block): the two slices of the table of p are sent to it (a slice is copied once per block it is paired
with), it makes both dense and sums the terms of its block for every pair of its groups. These partial
divergences are then summed along the term axis. Cells hold ``block_groups`` x ``block_terms`` numbers per slice
whatever the size of the corpus; pairs (i, j) and (j, i) share a cell.

Counting: each task counts the terms of its documents per group and sends one row per (group, term), so a source
or a term that holds a third of all rows costs as many rows as there are tasks.

Edge cases: NULL language, source or text count as empty; groups without terms exist, with value 0 where the
language keeps no term; rows of equal value are ranked by the item's UTF-8 bytes; a language of one source has no
pairs; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laminar.llm.common import materialise

# Letters A-Z are lower-cased, every other ASCII byte that is no letter separates terms.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SCALE = 1_000_000_000


def terms_of(text: str | bytes | None) -> list[bytes]:
    data = text.encode() if isinstance(text, str) else text or b""
    return data.translate(_TABLE).split()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                flush: int = 300_000) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents per group and term; term NULL stands for the group itself."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                          for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])

    def count(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def rows():
            for (lang, source), (n, docs_with) in held.items():
                terms = [None, *n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                     pa.array(terms, pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()),
                     pa.array([0, *(docs_with[t] for t in n)], pa.int64())], names=["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                n, docs_with = held.setdefault((lang, source), (Counter(), Counter()))
                words, before = terms_of(text), len(n)
                n.update(words)
                docs_with.update(set(words))
                size += len(n) - before
                if size > flush:
                    yield from rows()
                    size = 0
        yield from rows()

    counted = plain.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _p(n: str, total: str, kept: str):
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)) in decimals, NULL where nothing is kept."""
    return F.expr(f"CAST(1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0))) "
                  f"div nullif(CAST({total} + 2 * {kept} AS DECIMAL(20,0)), 0) AS BIGINT)")


def cell_sums(sources: list[list[str]], tables: list[np.ndarray], same: bool) -> list[tuple[str, str, int]]:
    """(source a, source b, partial divergence) for every pair of a cell's two slices."""
    out = []
    for k, (a, row) in enumerate(zip(sources[0], tables[0], strict=True)):
        first = k + 1 if same else 0
        other = tables[1][first:]
        if not len(other):
            continue
        diff, both = other - row, other + row
        sums = (diff * diff // np.maximum(both, 1)).sum(axis=1)
        out += [(a, b, int(s)) for b, s in zip(sources[1][first:], sums, strict=True)]
    return out


def distributions(counts: DataFrame, min_docs: int, block_groups: int, block_terms: int) -> tuple[DataFrame, DataFrame]:
    """(heads, entries): each group with its place and the p of an absent term, once per term block of its language; the p
    of every present kept term."""
    words = counts.where("term IS NOT NULL")
    kept = materialise(words.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                       .where(F.col("docs") >= min_docs).drop("docs"), "kept")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    # as many term blocks as the largest language needs, so that a term finds its block alone
    blocks = max(1, -(-(langs.agg(F.max("v")).first()[0] or 0) // block_terms))
    dealt = kept.withColumn("t", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int"))
    placed = dealt.withColumn("tid", F.row_number().over(W.partitionBy("lang", "t").orderBy("term")) - 1)
    present = materialise(words.where("n > 0").join(placed, ["lang", "term"])
                          .select("lang", "source", "term", "n", "lang_n", "t", "tid"), "present")
    totals = present.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    own = W.partitionBy("lang")                                  # over a row per group
    groups = (counts.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .fillna(0, ["total", "v", "lang_total"])
              .withColumn("g", F.row_number().over(own.orderBy("source")) - 1)
              .withColumn("g_blocks", F.ceil(F.count(F.lit(1)).over(own) / block_groups).cast("int"))
              .withColumn("block", F.floor(F.col("g") / block_groups).cast("int"))
              .withColumn("p0", F.coalesce(_p("0", "total", "v"), F.lit(0))))
    groups = materialise(groups, "groups")
    widths = dealt.groupBy("lang", "t").agg(F.count(F.lit(1)).alias("width"))
    heads = (groups.join(widths, "lang", "left").fillna(0, ["t", "width"])
             .select("lang", "t", "block", "g_blocks", "g", "p0", "source", "width"))
    entries = (present.join(groups.select("lang", "source", "total", "v", "lang_total", "g", "g_blocks", "block"), ["lang", "source"])
               .withColumn("p", _p("n", "total", "v")).withColumn("q", _p("lang_n", "lang_total", "v")))
    return heads, entries.select("lang", "source", "term", "t", "tid", "g", "g_blocks", "block", "p", "q")


def pair_divergences(heads: DataFrame, entries: DataFrame) -> DataFrame:
    """(lang, a, b, value) once per unordered pair of sources of a language."""
    slices = (heads.select("lang", "t", "block", "g_blocks", "g", F.lit(-1).alias("tid"), F.col("p0").alias("p"), "source", "width")
              .unionByName(entries.select("lang", "t", "block", "g_blocks", "g", "tid", "p", F.lit(None).cast("string").alias("source"),
                                          F.lit(None).cast("bigint").alias("width"))))
    # each slice goes to the cells of its block and every other one
    cells = (slices.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g_blocks") - 1)))
             .select("lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "t", "block", "g", "tid", "p",
                     "source", "width"))

    def cell(table: pa.Table) -> pa.Table:
        lang, i, j = (table.column(c)[0].as_py() for c in ("lang", "i", "j"))
        block, g, tid, p = (table.column(c).to_numpy() for c in ("block", "g", "tid", "p"))
        source, width = table.column("source"), pc.max(table.column("width")).as_py()       # of the heads
        sides, arrays = [], []
        for b in dict.fromkeys((i, j)):
            heads = np.flatnonzero((block == b) & (tid < 0))
            heads = heads[np.argsort(g[heads])]
            dense = np.repeat(p[heads].astype(np.int64)[:, None], width, axis=1)
            rows = np.flatnonzero((block == b) & (tid >= 0))
            dense[np.searchsorted(g[heads], g[rows]), tid[rows]] = p[rows]
            sides.append([source[int(k)].as_py() for k in heads])
            arrays.append(dense)
        found = cell_sums([sides[0], sides[-1]], [arrays[0], arrays[-1]], i == j)
        return pa.table({"lang": pa.array([lang] * len(found), pa.string()), "a": pa.array([x[0] for x in found], pa.string()),
                         "b": pa.array([x[1] for x in found], pa.string()), "value": pa.array([x[2] for x in found], pa.int64())})

    partial = cells.groupBy("lang", "i", "j", "t").applyInArrow(cell, "lang string, a string, b string, value bigint")
    return partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, block_groups: int = 16, block_terms: int = 1 << 12) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows for all other sources, ``term`` rows for the ``top`` terms
    that a source holds more of than its language."""
    counts = materialise(term_counts(docs), "terms")
    heads, entries = distributions(counts, min_docs, block_groups, block_terms)
    pairs = pair_divergences(heads, entries)
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                  F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    order = [F.col("value").desc(), F.col("item").asc()]
    pair = (both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
            .withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(*order))))
    term = (entries.where("p > q")
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                    F.expr("(p - q) * (p - q) div (p + q)").alias("value"), "t")
            # the best of each term block first, so that a group's ranking reads ``top`` rows per block
            .withColumn("rank", F.row_number().over(W.partitionBy("lang", "source", "t").orderBy(*order))).where(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(*order))).where(F.col("rank") <= top)
            .drop("t"))
    return pair.unionByName(term)
