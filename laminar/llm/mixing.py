"""Mixing sources to target weights along a time-varying curriculum (DataFrame operations only).

Targets. Sources share ``budget`` x all words by weight; a target stops at
``max_epochs`` x its source's size and the excess is shared again by weight
among the others until none is above (water filling: with sources sorted by
size / weight, the capped ones are a prefix of that order).

Curriculum. Training time runs from 0 to 1. Each source demands words at
rate target x w(t) / integral(w), w being its piecewise linear schedule. The
demand is integrated, and a document copy whose middle is the x-th word of its
source's stream (documents in md5 order, pass after pass) gets the
time t at which the integrated demand reaches x: the inverse of a
piecewise quadratic. Copies beyond the target get no time and are not taken, so a
source misses its target by half a document at most. ``mixture`` sorts copies by time
into ranges.

Running sums per source come from ranges of (source, md5): each range is summed up on its own and gets its
offset from the sums of the ranges before it, so a
source or an id with a third of all rows is spread over many sorts. Equal rows are one narrow row with a count, however
many they are, and get their places by arithmetic. Texts are fetched by the rows' content keys at the end.

Edge cases: NULL or empty texts have size 0 and are never taken; a NULL source is a
source of its own, last in order; sources of size 0 have target 0; repeated rows
count each; rows of one id and size are ordered by a hash of their content, so reruns agree whatever the input's order; an empty
table gives no rows. Other columns are kept under their names, whatever they are (those the operator adds replace columns of
the same name).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laminar.llm.common import fetched, field, keyed, running

WEIGHTS = (5, 2, 1)
# One schedule per weight class, (time, weight) knots: the heavy sources fade, the light ones grow.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 0.75), (1.0, 2.0)))


def word_count(text: Column) -> Column:
    """Number of words of a text: the starts of runs of non-space characters; NULL: 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def time_at(share: Column, knots) -> Column:
    """Time at which a schedule has demanded ``share`` (0..1) of its whole demand."""
    parts, area = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        parts.append((area, t0, t1, w0, w1))
        area += (t1 - t0) * (w0 + w1) / 2
    if area <= 0 or knots[0][0] != 0 or knots[-1][0] != 1:
        raise ValueError("a schedule needs a positive area and knots from time 0 to time 1")
    out = F.lit(1.0)
    for begin, t0, t1, w0, w1 in reversed(parts):
        need = F.greatest(share * F.lit(area) - F.lit(begin), F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        if slope == 0:
            step = need / F.lit(w0) if w0 else F.lit(0.0)
        else:   # w0 x + slope x^2 / 2 = need
            step = (F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * need, F.lit(0.0))) - F.lit(w0)) / F.lit(slope)
        end = begin + (t1 - t0) * (w0 + w1) / 2
        out = F.when(share * F.lit(area) <= F.lit(end), F.least(F.lit(t0) + step, F.lit(t1))).otherwise(out)
    return out


def source_targets(per_source: DataFrame, weights=WEIGHTS, budget: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """(source, source_size, class, target) from (source, source_size): one row per source."""
    # Single-partition windows over one row per source.
    ranked = (per_source.withColumn("class", (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights))
              .withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("class") + 1))
              .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))))
    order = W.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    past, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    total = F.sum("source_size").over(W.partitionBy())
    level = ((total * F.lit(float(budget)) - F.coalesce(F.sum("cap").over(past), F.lit(0.0))) / F.sum("w").over(rest))
    return (ranked.withColumn("level", level)
            # the first source that its level does not fill sets the level of all after it
            .withColumn("level", F.first(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level")), ignorenulls=True)
                        .over(order.rowsBetween(W.unboundedPreceding, 0)))
            .select("source", "source_size", "class",
                    F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("w")), F.col("cap")).alias("target")))


def placements(rows: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, budget: float = 1.5, max_epochs: int = 2,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, size, source_size, target, taken, times and the content key for each of ``keyed``'s rows, and in ``copies`` how many equal it.

    ``times`` has one time per copy taken, ascending. A source's stream is in order of the md5 of the id.
    """
    narrow = rows.select("_k1", "_k2", field(id_col).alias("id"), field(source_col).alias("source"), word_count(field(text_col)).alias("size"))
    classes = (narrow.groupBy("_k1", "_k2", "id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
               .withColumn("key", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")))
               .withColumn("words", F.col("size") * F.col("copies")))
    placed = running(classes, ["source"], ["key", "id", "size", "_k1", "_k2"], "words", "mixing")
    sizes = placed.groupBy("source").agg(F.first("total").alias("source_size"))
    targets = source_targets(sizes, weights, budget, max_epochs).withColumnRenamed("source", "s")
    each = (placed.join(targets, F.col("source").eqNullSafe(F.col("s")))
            .withColumn("nth", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))))
    middle = F.col("before") + F.col("nth") * F.col("size") + F.col("size") / F.lit(2.0)
    share = [(middle + F.col("source_size") * F.lit(float(k))) / F.nullif(F.col("target"), F.lit(0.0))
             for k in range(max_epochs)]

    def when(x):
        chosen = time_at(x, schedules[0])
        for i, knots in enumerate(schedules[1:], 1):
            chosen = F.when(F.col("class") % len(schedules) == i, time_at(x, knots)).otherwise(chosen)
        return F.when((F.col("size") > 0) & (x < 1), chosen)

    times = F.filter(F.array(*[when(x) for x in share]), lambda t: t.isNotNull())
    return (each.withColumn("times", times).withColumn("taken", F.size("times") * F.col("size"))
            .select("_k1", "_k2", "id", "size", "source_size", "target", "taken", "times", "copies"))


def positions(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with size, source_size, target, taken and times (one per copy taken, ascending)."""
    own = ("size", "source_size", "target", "taken", "times")
    rows, columns = keyed(docs, *own)
    return fetched(rows, columns, placements(rows, **options), *own)


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: one row per copy taken, with its ``position`` (training time), range-sorted by it."""
    rows, columns = keyed(docs, "position")
    taken = placements(rows, **options).withColumn("position", F.explode("times"))
    return fetched(rows, columns, taken, "position").repartitionByRange("position").sortWithinPartitions("position")
