"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics of every whole text (shares of character classes, word and line shape, repetition).
2. Small boosted trees are grown on labelled rows; every path from a root to a node is a rule, a
   conjunction of ``statistic <= value`` and ``statistic > value``.
3. A lasso logistic regression over the rules (0/1) keeps few of them.
4. The rules that are left are compiled into one SQL expression over the statistics.

Training uses at most ``MAX_SAMPLE`` labelled rows (the smallest hashes of the id), none of which is
held out; ids, sources and languages are not statistics.

Edge cases: NULL and empty texts have all statistics 0 and get a score; rows without a label, with NULL
labels or several labels for one id (the smallest counts) are allowed; labels of one class or none give
a constant score; repeated rows give one row each; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import operator
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import id_remainder, text_bytes

MAX_SAMPLE, HELD_OUT_MOD = 20_000, 5
TREES, DEPTH, BINS, RATE, MIN_LEAF, PENALTY = 24, 3, 32, 0.3, 20, 0.002

STATISTICS = ("log_bytes", "log_words", "word_length", "upper", "digits", "symbols", "bangs", "pipes", "marks", "other_bytes",
              "distinct_words", "top_word", "adjacent", "repeated_lines", "line_words", "closed_lines", "shout_words", "marked_words")
_UPPER, _DIGITS = slice(65, 91), slice(48, 58)
_SYMBOLS = [ord(c) for c in "#*$%&|<>"]
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]


def statistics(text: bytes) -> tuple[float, ...]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    words = text.split()
    if not words:
        return (float(np.log1p(len(text))),) + (0.0,) * (len(STATISTICS) - 1)
    n, counts = len(words), np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    solid = max(1, sum(map(len, words)))
    lines = [line for line in text.split(b"\n") if line.strip()]
    tally = Counter(words)
    return (
        float(np.log1p(len(text))), float(np.log1p(n)), solid / n, counts[_UPPER].sum() / solid, counts[_DIGITS].sum() / solid,
        counts[_SYMBOLS].sum() / solid, counts[33] / n, counts[124] / n, counts[_MARKS].sum() / solid, counts[128:].sum() / solid,
        len(tally) / n, max(tally.values()) / n, sum(map(operator.eq, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines), n / len(lines), sum(line.rstrip().endswith((b".", b"!", b"?")) for line in lines) / len(lines),
        sum(map(bytes.isupper, words)) / n, sum(w[-1] in b"#*$%&!" for w in words) / n)


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, statistics...) per row."""
    def run(batches):
        for batch in batches:
            values = np.array([statistics(t) for t in batch.column(1).to_pylist()], float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, values.T)], ["doc_id", *STATISTICS])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_bytes(F.col(text_col)).alias("t")).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATISTICS))


def _grow(x, g, h, bins, rows, depth, rule, rules):
    """One regression tree on gradients ``g`` and weights ``h``; appends (rule, rows, value) per node and returns the leaves."""
    value = g[rows].sum() / (h[rows].sum() + 1.0)
    if rule:
        rules.append(tuple(sorted(rule)))
    best = (1e-6, None)
    if depth and len(rows) >= 2 * MIN_LEAF:
        whole = g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
        for j, edges in enumerate(bins):
            if not len(edges):
                continue
            slot = np.searchsorted(edges, x[rows, j])           # <= edges[k] goes to slots 0..k
            gs = np.bincount(slot, g[rows], len(edges) + 1).cumsum()[:-1]
            hs = np.bincount(slot, h[rows], len(edges) + 1).cumsum()[:-1]
            ns = np.bincount(slot, minlength=len(edges) + 1).cumsum()[:-1]
            gain = gs ** 2 / (hs + 1) + (g[rows].sum() - gs) ** 2 / (h[rows].sum() - hs + 1) - whole
            gain[(ns < MIN_LEAF) | (len(rows) - ns < MIN_LEAF)] = -1
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (j, float(edges[k])))
    if best[1] is None:
        return [(rows, value)]
    j, edge = best[1]
    left = x[rows, j] <= edge
    return (_grow(x, g, h, bins, rows[left], depth - 1, rule + [(j, "<=", edge)], rules)
            + _grow(x, g, h, bins, rows[~left], depth - 1, rule + [(j, ">", edge)], rules))


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[tuple]:
    """Distinct rules, tuples of (statistic, '<=' or '>', value), of boosted trees."""
    bins = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    margin, rules = np.full(len(y), np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        for rows, value in _grow(x, y - p, p * (1 - p), bins, np.arange(len(y)), DEPTH, [], rules):
            margin[rows] += RATE * value
    return list(dict.fromkeys(rules))


def _holds(rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, sign, edge in rule:
        out &= x[:, j] <= edge if sign == "<=" else x[:, j] > edge
    return out


def lasso(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of a logistic regression with an absolute penalty (accelerated proximal gradient)."""
    mean = z.mean(axis=0)
    centred = z - mean
    size = 4 / max(1e-9, np.linalg.norm(centred, 2) ** 2 / len(y) + 1)
    w, b, past_w, past_b = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1]), 0.0
    for k in range(steps):
        ahead_w, ahead_b = w + k / (k + 3) * (w - past_w), b + k / (k + 3) * (b - past_b)
        error = 1 / (1 + np.exp(-(centred @ ahead_w + ahead_b))) - y
        past_w, past_b = w, b
        step = ahead_w - size * (centred.T @ error) / len(y)
        w, b = np.sign(step) * np.maximum(np.abs(step) - size * penalty, 0), ahead_b - size * error.mean()
    return float(b - mean @ w), w


def training_rows(labels: DataFrame, label: str, max_sample: int, mod: int = HELD_OUT_MOD) -> DataFrame:
    """(doc_id, label) of the at most ``max_sample`` labelled rows that are not held out, by hash of the id."""
    return (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (id_remainder(F.col("doc_id"), mod) != 0))
            .groupBy("doc_id").agg(F.min(label).alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_sample))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_sample: int = MAX_SAMPLE) -> list[tuple[tuple, float]]:
    """[(rule, weight)], the empty rule being the intercept."""
    sample = F.broadcast(training_rows(labels, label, max_sample))       # at most max_sample narrow rows
    rows = with_statistics(docs.select("doc_id", "text").join(sample, "doc_id", "left_semi")).join(sample, "doc_id")
    # of texts that share an id one is learnt from, the least by its statistics: at most max_sample rows, the same in each run
    least = rows.groupBy("doc_id", "label").agg(F.min(F.struct(*STATISTICS)).alias("s")).select("doc_id", "label", "s.*")
    table = least.toPandas().sort_values(["doc_id", *STATISTICS])
    x, y = table[list(STATISTICS)].to_numpy(float), table["label"].to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        return [((), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))]
    rules = tree_rules(x, y)
    if not rules:
        return [((), float(np.log(y.mean() / (1 - y.mean()))))]
    intercept, weights = lasso(np.stack([_holds(r, x) for r in rules], axis=1).astype(float), y)
    return [((), intercept)] + [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w]


def compiled(model) -> Column:
    """The score of a model as one expression over the statistics."""
    terms = []
    for rule, weight in model:
        when = " and ".join(f"{STATISTICS[j]} {sign} {edge!r}D" for j, sign, edge in rule)
        terms.append(f"if({when}, {weight!r}D, 0D)" if when else f"{weight!r}D")
    return F.expr(f"1 / (1 + exp(-({' + '.join(terms)})))")


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) per row."""
    return with_statistics(docs, id_col, text_col).select("doc_id", compiled(model).alias("score"))
