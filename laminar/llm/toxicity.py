"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features of a text: which words occur in it (A-Z lower-cased, marks at the ends cut off), as whole words and
by their first four and five bytes, hashed. P(grade <= k) = sigmoid(theta_k - w.x): one weight vector
for all thresholds theta_1 < theta_2. The expected severity is the sum of P(grade >= k).

Labels are binary, so grade 0 is the label 0, and the rows of label 1 are split at the median of
how many label-1 features they hold: grade 1 up to it, grade 2 above.

Training uses at most ``MAX_TOXIC`` rows of label 1 and ``MAX_CLEAN`` of label 0 (the smallest hashes
of the id). Each class is weighted by its labelled rows over its sampled rows, counted over all training labels, so
that the probabilities are those at the labels' own class shares whatever the input's size.
Ids with crc32 mod 5 = 0 are held out. Features that the labels do not separate (G statistic) are left out.

A row is rejected when P(grade >= 1) >= ``REJECT``.

Edge cases: NULL and empty texts have no features and the severity of the thresholds alone; rows
without labels, NULL labels and several labels of one id (the largest counts) are allowed; without both
classes no feature is kept and nothing is rejected; repeated rows give one row
each; an empty table gives no rows. Extra columns are ignored by ``score`` and kept by ``keep_clean``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import id_remainder, materialise, text_bytes

MAX_TOXIC, MAX_CLEAN, HELD_OUT_MOD = 3_000, 4_000, 5
SPACE_BITS, MIN_ROWS, MIN_G, RIDGE, REJECT = 21, 3, 15.0, 1e-4, 0.3
CACHE_WORDS = 300_000
_EDGES = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashed features of one word: itself and its first four and five bytes."""
    core = word.lower().strip(_EDGES)
    if len(core) < 3:
        return ()
    named = (core, b"4:" + core[:4], b"5:" + core[:5]) if len(core) >= 5 else (core, b"4:" + core[:4])
    return tuple(zlib.crc32(f) >> (32 - SPACE_BITS) for f in named)


def _training(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): one label for each id that is not held out."""
    return (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (id_remainder(F.col("doc_id"), HELD_OUT_MOD) != 0))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))


def _sample(one: DataFrame) -> DataFrame:
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    return (one.filter("toxic = 1").orderBy(*order).limit(MAX_TOXIC)
            .unionByName(one.filter("toxic = 0").orderBy(*order).limit(MAX_CLEAN)))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """{"weights": {feature: weight}, "thresholds": [theta_1, theta_2]}."""
    @F.pandas_udf("array<int>")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted({f for w in set(t.split()) for f in word_features(w)}))

    one = _training(labels)
    counts = {r.toxic: r["count"] for r in one.filter("toxic in (0, 1)").groupBy("toxic").count().collect()}
    # labelled rows for each sampled one, by class
    odds = np.array([max(1.0, counts.get(k, 0) / most) for k, most in enumerate((MAX_CLEAN, MAX_TOXIC))])
    sample = F.broadcast(_sample(one))                        # at most MAX_TOXIC + MAX_CLEAN narrow rows
    # of texts that share an id one is learnt from, that of the least hash: a row per label, the same in each run
    rows = materialise(docs.select("doc_id", "text").join(sample, "doc_id")
                       .select("doc_id", "toxic", features(text_bytes(F.col("text"))).alias("f"), F.xxhash64("text").alias("h"))
                       .groupBy("doc_id", "toxic").agg(F.min_by("f", "h").alias("f")), "toxicity-sample")
    # only features that may be kept come to the driver
    seen = rows.select("doc_id", "toxic", F.explode("f").alias("x"))
    total, mine = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = mine / total if total else 0.5
    clear = (seen.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("a"))
             .filter((F.col("n") >= MIN_ROWS) & (separation(F.col("a"), F.col("n"), share) >= MIN_G - 1e-6)).select("x"))
    kept = seen.join(clear, "x").groupBy("doc_id").agg(F.sort_array(F.collect_list("x")).alias("f"))
    small = (rows.select("doc_id", "toxic").join(kept, "doc_id", "left")
             .withColumn("f", F.coalesce("f", F.array().cast("array<int>"))).toPandas().sort_values("doc_id"))
    toxic = small["toxic"].to_numpy(np.int64)
    return fit_rows([np.asarray(f, np.int32) for f in small["f"]], toxic, odds[toxic])


def separation(a: Column, n: Column, share: float) -> Column:
    """The G statistic of a feature in n rows, a of them toxic, where a share of all rows is."""
    toxic, clean = F.lit(float(share)), F.lit(float(1 - share))
    return 2 * (F.when((a > 0) & (toxic > 0), a * F.log(a / (n * toxic))).otherwise(0.0)
                + F.when((n > a) & (clean > 0), (n - a) * F.log((n - a) / (n * clean))).otherwise(0.0))


def fit_rows(features: list[np.ndarray], toxic: np.ndarray, stands_for: np.ndarray | None = None) -> dict:
    """``stands_for``: how many labelled rows each row stands for (one, if not given)."""
    empty = {"weights": {}, "thresholds": [10.0, 11.0]}
    if len(toxic) == 0 or toxic.min() == toxic.max():
        return empty
    row = np.repeat(np.arange(len(features), dtype=np.int32), [len(f) for f in features])
    column = np.concatenate(features).astype(np.int32)
    size, total, mine = 1 << SPACE_BITS, len(toxic), toxic.sum()
    n = np.bincount(column, minlength=size)
    often = np.flatnonzero(n >= MIN_ROWS)
    n, a = n[often].astype(float), np.bincount(column[toxic[row] == 1], minlength=size)[often].astype(float)
    share = mine / total
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(a > 0, a * np.log(a / (n * share)), 0) + np.where(n > a, (n - a) * np.log((n - a) / (n * (1 - share))), 0))
    clear = g >= MIN_G
    chosen, a, n = often[clear], a[clear], n[clear]
    if not len(chosen):
        return empty
    index = np.full(size, -1)
    index[chosen] = np.arange(len(chosen))
    use = index[column] >= 0
    row, column = row[use], index[column[use]]
    speaks = (a > n * share)[column]
    hits = np.bincount(row[speaks], minlength=total)
    cut = np.median(hits[toxic == 1])
    grade = np.where(toxic == 0, 0, np.where(hits > cut, 2, 1))
    weights, thresholds = cumulative_link(row, column, grade, len(chosen), stands_for=stands_for)
    keep = np.abs(weights) > 1e-3
    return {"weights": dict(zip(chosen[keep].tolist(), weights[keep].tolist(), strict=True)), "thresholds": thresholds}


def cumulative_link(row, column, grade, n_features: int, steps: int = 400, rate: float = 0.05,
                    stands_for: np.ndarray | None = None) -> tuple[np.ndarray, list[float]]:
    """Shared weights and two ordered thresholds by full-batch Adam on the weighted mean; theta_2 = theta_1 + exp(gap)."""
    params, first, second = np.zeros(n_features + 2), np.zeros(n_features + 2), np.zeros(n_features + 2)
    params[-2], total = 2.0, len(grade)
    part = np.ones(total) if stands_for is None else stands_for / stands_for.mean()
    sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))
    for k in range(1, steps + 1):
        w, t1, t2 = params[:-2], params[-2], params[-2] + np.exp(params[-1])
        x = np.bincount(row, w[column], minlength=total)
        low, high = sigmoid(t1 - x), sigmoid(t2 - x)
        p = np.clip(np.choose(grade, [low, high - low, 1 - high]), 1e-9, None)
        d1, d2 = low * (1 - low), high * (1 - high)
        by1 = part * np.choose(grade, [d1, -d1, 0 * d1]) / p     # d log p / d theta_1, theta_2
        by2 = part * np.choose(grade, [0 * d2, d2, -d2]) / p
        grad_x = -(by1 + by2)
        slope = np.concatenate((np.bincount(column, grad_x[row], minlength=n_features) / total - RIDGE * w,
                                [(by1 + by2).mean(), by2.mean() * np.exp(params[-1])]))
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope ** 2
        params = params + rate * (first / (1 - 0.9 ** k)) / (np.sqrt(second / (1 - 0.999 ** k)) + 1e-8)
    return params[:-2], [float(params[-2]), float(params[-2] + np.exp(params[-1]))]


def margin(model: dict, text: Column) -> Column:
    """w.x of each text, by a vectorised function over the UTF-8 bytes; the model has at most 2^SPACE_BITS weights."""
    weights = model["weights"]

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        known: dict[bytes, tuple[int, ...]] = _CACHES.setdefault(id(weights), {})

        def one(t: bytes) -> float:
            words = set(t.split())
            for w in words:
                if w not in known:
                    known[w] = tuple(f for f in word_features(w) if f in weights)
            found = {f for w in words for f in known[w]}
            if len(known) > CACHE_WORDS:
                known.clear()
            return float(sum(weights[f] for f in sorted(found)))
        return texts.map(one).astype(float)
    return run(text_bytes(text))


_CACHES: dict[int, dict] = {}


def severity(model: dict, x: Column) -> Column:
    """Expected grade: the sum of P(grade >= k)."""
    parts = [1 / (1 + F.exp(F.lit(t) - x)) for t in model["thresholds"]]
    return parts[0] + parts[1]


def rejected(model: dict, x: Column) -> Column:
    return 1 / (1 + F.exp(F.lit(model["thresholds"][0]) - x)) >= F.lit(REJECT)


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, grade, toxic) per row; grade is the likeliest grade."""
    marked = docs.select(F.col(id_col).alias("doc_id"), margin(model, F.col(text_col)).alias("x"))
    t1, t2 = model["thresholds"]
    low, high = (1 / (1 + F.exp(F.col("x") - F.lit(t))) for t in (t1, t2))
    grade = F.when((low >= high - low) & (low >= 1 - high), 0).when(high - low >= 1 - high, 1).otherwise(2)
    return marked.select("doc_id", severity(model, F.col("x")).alias("severity"), grade.alias("grade"),
                         rejected(model, F.col("x")).alias("toxic"))


def keep_clean(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` without the rejected rows, all columns as they were."""
    return docs.filter(~rejected(model, margin(model, F.col(text_col))))
