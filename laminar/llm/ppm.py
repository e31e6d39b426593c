"""Language-model scores by prediction by partial matching over bytes, beside a word unigram base.

Model. The trie of all byte contexts of up to ``ORDER`` = 5 bytes is counted over the training texts
(start of text and end of text are bytes that UTF-8 never uses). The probability of a byte starts at the longest context; an escape
(method C: distinct symbols against occurrences) leads to the next shorter one, where the symbols of the longer
context are excluded from the counts; after order 0 the bytes never seen are equally likely. The
model is fixed before scoring, so a text's code length is the sum over its bytes and its end.

Plan. Texts are dealt into blocks of about ``BLOCK_BYTES``, and what blocks ask for into as many buckets, by hash.
Copies of a row (same id and text) that would fill a good part of a block are one row with a count.

1. Each block lists its distinct windows (context and byte) and distinct tokens with their training counts: all the model
   needs, and all the block needs to look up. A (block, bucket) pair is one packed row, sorted, and is left out if empty.
2. Token counts are summed per bucket, and each block's piece is answered by the counts in the piece's own order.
3. Window counts are summed per bucket. The windows that share the two bytes before the last hold all that their contexts of
   2 bytes and more need, so they get their probabilities together; shorter contexts come from
   one table of byte pairs (at most 256 x 256 counts, so it is sent to every task). A pair that holds very many windows is
   split by the byte before it; what its 2-byte context needs (at most 256 counts) goes along with each part.
4. The bucket's pieces are answered by the values, and a block's answers meet its texts again.

No vocabulary or trie is collected or broadcast, so both may grow with the corpus; a task holds
one block and its answers, one bucket of pieces, or the distinct windows of one group of byte pairs.

The base is the sum over tokens (words and one end) of log10((c + 1) / (N + V + 1)), c, N and V being counts of training tokens.

Edge cases: NULL and empty texts consist of their end; repeated rows give one row each; ids that are NULL count
as the empty text for the hold-out; without training texts every byte is equally likely and N = V = 0; an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import id_remainder, materialise, text_bytes

ORDER, BLOCK_BYTES = 5, 12 << 20
START, END = b"\xff" * ORDER, b"\xfe"
SYMBOLS = 255                       # all bytes but the start mark
END_TOKEN = b"\n"                   # not a word: it is white space
SLAB = 1 << 20                      # windows handled at once
GROUP_WINDOWS = 500_000             # distinct windows a task gives probabilities to, on average
HOT_WINDOWS = 4 * GROUP_WINDOWS     # a pair of bytes with more is split by the byte before it
TOKENS, WINDOWS = 0, 1              # kinds of pieces
PIECES = "block bigint, bucket int, kind int, body binary, n binary"


def _windows(texts: list[bytes], slab: int = SLAB) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(windows that end at each byte and at each end, number of the text of each), a slab at a time."""
    data = np.frombuffer(b"".join(START + t + END for t in texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1 + ORDER
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    for a in range(0, len(data) - ORDER, slab):
        b = min(a + slab, len(data) - ORDER)
        grams = np.zeros(b - a, np.int64)
        for k in range(ORDER + 1):
            grams = grams << 8 | data[a + k:b + k]
        inside = owner[a:b] == owner[a + ORDER:b + ORDER]        # the others run into the next text
        yield grams[inside], owner[a:b][inside]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, distinct = pd.factorize(np.concatenate(keys))
    total = np.bincount(codes, np.concatenate(counts), len(distinct)).astype(np.int64)
    order = np.argsort(distinct)
    return distinct[order], total[order]


def _distinct_windows(texts: list[bytes], train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows of a block and how often they occur in the texts marked ``train``."""
    keys, counts, held = [], [], 0
    for grams, owner in _windows(texts):
        marked = np.sort(grams << 1 | train[owner])               # a plain sort is the fastest way to group
        begin = np.flatnonzero(np.diff(marked, prepend=-1))
        keys.append(marked[begin] >> 1)
        counts.append(np.diff(begin, append=len(marked)) * (marked[begin] & 1))
        held += len(begin)
        if held > 4 * SLAB:                                       # bounded memory for many slabs
            keys, counts = ([x] for x in _summed(keys, counts))
            held = len(keys[0])
    return _summed(keys, counts)


def _token_bucket(token: bytes, buckets: int) -> int:
    return zlib.crc32(token) % buckets


def _window_bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    mixed = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _window_pieces(grams: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places in ``grams``) of each bucket that has any; places ascend."""
    bucket = _window_bucket(grams, buckets)
    order = np.argsort(bucket, kind="stable")
    used, begin = np.unique(bucket[order], return_index=True)
    return zip(used.tolist(), np.split(order, begin[1:]), strict=True) if len(used) else iter(())


def _packed(grams: np.ndarray) -> bytes:
    return np.diff(grams, prepend=0).astype("<i8").tobytes()


def _unpacked(body: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(body, "<i8"))


def _words(text: bytes) -> list[bytes]:
    words = text.lower().split()
    words.append(END_TOKEN)
    return words


def _token_pieces(tokens, buckets: int) -> dict[int, list[bytes]]:
    pieces: dict[int, list[bytes]] = {}
    for token in sorted(tokens):
        pieces.setdefault(_token_bucket(token, buckets), []).append(token)
    return pieces


def _questions(buckets: int, table: pa.Table) -> pa.Table:
    """Step 1: the pieces of a block."""
    texts, held, copies = table.column("t").to_pylist(), table.column("held_out").to_numpy(), table.column("copies").to_numpy()
    rows = []
    grams, counts = _distinct_windows(texts, ~held)
    # each text is counted once above, and its further copies here
    further = [(texts[k], int(copies[k]) - 1) for k in np.flatnonzero((copies > 1) & ~held).tolist()]
    for text, n in further:
        more, c = _distinct_windows([text], np.ones(1, bool))
        counts[np.searchsorted(grams, more)] += c * n
    for bucket, places in _window_pieces(grams, buckets):
        rows.append((bucket, WINDOWS, _packed(grams[places]), counts[places].astype("<i8").tobytes()))
    train, rest = Counter(), set()
    for text, out in zip(texts, held.tolist(), strict=True):
        (rest if out else train).update(_words(text))
    for text, n in further:
        for token, c in Counter(_words(text)).items():
            train[token] += c * n
    for bucket, tokens in _token_pieces(train.keys() | rest, buckets).items():
        rows.append((bucket, TOKENS, b" ".join(tokens), np.array([train[t] for t in tokens], "<i8").tobytes()))
    bucket, kind, body, n = zip(*rows, strict=True)
    return pa.table({"block": pa.array([table.column("block")[0].as_py()] * len(rows), pa.int64()), "bucket": pa.array(bucket, pa.int32()),
                     "kind": pa.array(kind, pa.int32()), "body": pa.array(body, pa.binary()), "n": pa.array(n, pa.binary())})


def _count_tokens(table: pa.Table) -> pa.Table:
    """Step 2: the answers to a bucket's pieces; the first one carries the bucket's occurrences and distinct tokens."""
    total = Counter()
    pieces = [body.split(b" ") for body in table.column("body").to_pylist()]
    for tokens, n in zip(pieces, table.column("n").to_pylist(), strict=True):
        for token, c in zip(tokens, np.frombuffer(n, "<i8").tolist(), strict=True):
            total[token] += c
    bodies = [np.fromiter(map(total.__getitem__, tokens), "<i8", len(tokens)).tobytes() for tokens in pieces]
    tail = [0] * (len(pieces) - 1)
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "kind": table.column("kind"), "body": pa.array(bodies, pa.binary()),
                     "total": pa.array([sum(total.values()), *tail], pa.int64()),
                     "seen": pa.array([sum(c > 0 for c in total.values()), *tail], pa.int64())})


def _count_windows(table: pa.Table) -> pa.Table:
    """Step 3: the distinct windows of a bucket."""
    grams, n = _summed([_unpacked(b) for b in table.column("body").to_pylist()],
                       [np.frombuffer(x, "<i8") for x in table.column("n").to_pylist()])
    return pa.table({"gram": grams, "n": n})


def _looked_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The value of each asked key, 0 if it is not there; ``keys`` ascend."""
    if not len(keys):
        return np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)


def _probabilities(pairs: tuple[np.ndarray, np.ndarray], buckets: int, table: pa.Table) -> pa.Table:
    """Step 3: log10 probabilities of all windows that share the two bytes before the last; pairs: counts of two bytes.

    With a column ``whole`` the windows share three bytes, and the rows marked so are the counts of their 2-byte contexts.
    """
    given = None
    if "whole" in table.column_names:
        marked = table.column("whole").to_numpy()
        given, table = table.filter(pa.array(marked)), table.filter(pa.array(~marked))
    grams, n = table.column("gram").to_numpy(), table.column("n").to_numpy()
    nodes = {ORDER: _summed([grams[n > 0]], [n[n > 0]]), 1: pairs, 0: _summed([pairs[0] & 0xFF], [pairs[1]])}
    for level in range(ORDER - 1, 1, -1):
        longer, counts = nodes[level + 1]
        nodes[level] = _summed([longer & (1 << 8 * (level + 1)) - 1], [counts])
    if given is not None:                                        # once, where several parts of a pair met in this group
        keys, at = np.unique(given.column("gram").to_numpy(), return_index=True)
        nodes[2] = keys, given.column("n").to_numpy()[at]
    value, todo = np.ones(len(grams)), np.ones(len(grams), bool)
    less_n = less_q = np.zeros(len(grams), np.int64)             # what the longer context excludes
    for level in range(ORDER, -1, -1):
        keys, counts = nodes[level]
        contexts, begin = np.unique(keys >> 8, return_index=True)
        held = _looked_up(*nodes[level - 1], keys & (1 << 8 * level) - 1) if level else np.zeros_like(counts)
        asked = grams & (1 << 8 * (level + 1)) - 1
        t = _looked_up(keys, counts, asked)
        total, distinct, below = (
            _looked_up(contexts, x, asked >> 8) for x in
            (np.add.reduceat(counts, begin) if len(begin) else counts, np.diff(begin, append=len(keys)),
             np.add.reduceat(held, begin) if len(begin) else held))
        left, escapes = (total - less_n).astype(float), (distinct - less_q).astype(float)
        hit, miss = todo & (t > 0), todo & (t == 0) & (escapes > 0)
        value[hit] *= t[hit] / (left + escapes)[hit]
        value[miss] *= escapes[miss] / (left + escapes)[miss]
        todo &= t == 0
        less_n, less_q = below, distinct
    value[todo] /= max(1, SYMBOLS - len(nodes[0][0]))
    return pa.table({"gram": grams, "bucket": _window_bucket(grams, buckets).astype(np.int32), "value": np.log10(value)})


def window_log10(windows: DataFrame, buckets: int = 1) -> DataFrame:
    """(gram, bucket, value): log10 probability of the last byte of each window given those before; windows: (gram, n)."""
    rows = (windows.filter("n > 0").groupBy((F.col("gram") % (1 << 16)).alias("pair")).agg(F.sum("n").alias("n"))
            .toPandas().sort_values("pair"))                     # at most 256 x 256 rows
    pairs = rows["pair"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    before = F.shiftright("gram", 8) % (1 << 16)
    held = windows.groupBy(before.alias("before")).agg(F.count(F.lit(1)).alias("n")).toPandas()     # at most 256 x 256 rows
    groups = max(1, math.ceil(held["n"].sum() / GROUP_WINDOWS))
    hot = held.loc[held["n"] > HOT_WINDOWS, "before"].tolist()
    schema = "gram bigint, bucket int, value double"

    def run(group: pa.Table) -> pa.Table:
        return _probabilities(pairs, buckets, group)

    if not hot:
        return windows.groupBy(F.pmod(F.xxhash64(before), F.lit(groups))).applyInArrow(run, schema)
    is_hot, three = before.isin(hot), F.shiftright("gram", 8) % (1 << 24)
    split = windows.filter(is_hot).select("gram", "n", three.alias("three"), F.lit(False).alias("whole"))
    # the counts of a hot pair's 2-byte context, for each of its parts
    own = (windows.filter(is_hot & (F.col("n") > 0)).groupBy((F.col("gram") % (1 << 24)).alias("gram")).agg(F.sum("n").alias("n"))
           .withColumn("pair", F.shiftright("gram", 8)))
    parts = split.select("three", (F.col("three") % (1 << 16)).alias("pair")).distinct()
    along = own.join(parts, "pair").select("gram", "n", "three", F.lit(True).alias("whole"))
    cold = windows.filter(~is_hot).groupBy(F.pmod(F.xxhash64(before), F.lit(groups))).applyInArrow(run, schema)
    return cold.unionByName(split.unionByName(along).groupBy(F.pmod(F.xxhash64("three"), F.lit(groups))).applyInArrow(run, schema))


def _answer_windows(left: pa.Table, right: pa.Table) -> pa.Table:
    """Step 4: the values of each piece of a bucket."""
    grams, value = right.column("gram").to_numpy(), right.column("value").to_numpy()
    order = np.argsort(grams)
    grams, value = grams[order], value[order]
    bodies = [value[np.searchsorted(grams, _unpacked(b))].astype("<f8").tobytes() for b in left.column("body").to_pylist()]
    return pa.table({"block": left.column("block"), "bucket": left.column("bucket"), "kind": left.column("kind"), "body": pa.array(bodies, pa.binary())})


def _answered(buckets: int, smoothed: float, left: pa.Table, right: pa.Table) -> pa.Table:
    """Scores of a block's texts from the answers to its pieces; smoothed: N + V + 1."""
    texts = left.column("t").to_pylist()
    told = {(k, b): body for k, b, body in zip(*(right.column(c).to_pylist() for c in ("kind", "bucket", "body")), strict=True)}
    grams, _ = _distinct_windows(texts, np.zeros(len(texts), bool))
    value, score = np.empty(len(grams)), np.zeros(len(texts))
    for bucket, places in _window_pieces(grams, buckets):
        value[places] = np.frombuffer(told[WINDOWS, bucket], "<f8")
    for slab, owner in _windows(texts, 1 << 16):                  # 48 bits of window and 16 bits of place are sorted as one number
        marked = np.sort(slab.astype(np.uint64) << np.uint64(16) | np.arange(len(slab), dtype=np.uint64))
        sorted_grams = (marked >> np.uint64(16)).astype(np.int64)
        begin = np.flatnonzero(np.diff(sorted_grams, prepend=-1))
        found = np.repeat(value[np.searchsorted(grams, sorted_grams[begin])], np.diff(begin, append=len(marked)))
        first = owner[0] if len(owner) else 0                     # owners ascend: only the texts of this slab
        sums = np.bincount(owner[(marked & np.uint64(0xFFFF)).astype(np.int64)] - first, found)
        score[first:first + len(sums)] += sums
    words, count = set(), {}
    for text in texts:
        words.update(_words(text))
    for bucket, tokens in _token_pieces(words, buckets).items():
        count.update(zip(tokens, np.frombuffer(told[TOKENS, bucket], "<i8").tolist(), strict=True))
    base, n_tokens, n_known = [], [], []
    for text in texts:
        words = _words(text)
        c = np.fromiter(map(count.__getitem__, words), np.int64, len(words))
        base.append(float(np.log10((c + 1) / smoothed).sum()))
        n_tokens.append(len(words))
        n_known.append(int((c > 0).sum()))
    return pa.table({"doc_id": left.column("doc_id"), "copies": left.column("copies"), "held_out": left.column("held_out"), "n_tokens": pa.array(n_tokens, pa.int64()),
                     "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(base, pa.float64()),
                     "score": pa.array(score, pa.float64()), "n_bytes": pa.array([len(t) for t in texts], pa.int64())})


def dealt(rows: DataFrame, mod: int, rest: int, block_bytes: int) -> tuple[DataFrame, int]:
    """((doc_id, t, copies, held_out, block), number of blocks); rows: (doc_id, t).

    Equal rows have one hash and so one block. Where they hold over a quarter of a block they become one row with a count.
    """
    rows = rows.withColumn("key", F.xxhash64("doc_id", "t"))
    size = F.sum(F.length("t") + 1)
    blocks = max(1, math.ceil((rows.agg(size).first()[0] or 0) / block_bytes))
    # at most four keys for each block's worth of text
    many = materialise(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), size.alias("size"))
                       .filter((F.col("n") > 1) & (F.col("size") > block_bytes // 4)).select("key"), "ppm-copies")
    single = rows.join(F.broadcast(many), "key", "left_anti").select("doc_id", "t", F.lit(1).cast("bigint").alias("copies"))
    counted = rows.join(F.broadcast(many), "key", "left_semi").groupBy("doc_id", "t").agg(F.count(F.lit(1)).alias("copies"))
    return (single.unionByName(counted)
            .select("doc_id", "t", "copies", (id_remainder(F.col("doc_id"), mod) == rest).alias("held_out"),
                    F.pmod(F.xxhash64("doc_id", "t"), F.lit(blocks)).alias("block"))), blocks


def score(docs: DataFrame, mod: int = 7, rest: int = 2, block_bytes: int = BLOCK_BYTES,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes) per row.

    Rows whose crc32(doc_id as text) mod ``mod`` is ``rest`` are held out of training.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(F.col(text_col)).alias("t"))
    blocked, blocks = dealt(rows, mod, rest, block_bytes)
    asked = materialise(blocked.groupBy("block").applyInArrow(lambda block: _questions(blocks, block), PIECES), "ppm")
    windows, tokens = asked.filter(F.col("kind") == WINDOWS), asked.filter(F.col("kind") == TOKENS)
    counts = materialise(tokens.groupBy("bucket").applyInArrow(
        _count_tokens, "block bigint, bucket int, kind int, body binary, total bigint, seen bigint"), "ppm-tokens")
    total, distinct = counts.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("seen"), F.lit(0))).first()
    counted = materialise(windows.groupBy("bucket").applyInArrow(_count_windows, "gram bigint, n bigint"), "ppm-windows")
    values = window_log10(counted, blocks)
    answers = (windows.drop("n").groupBy("bucket").cogroup(values.groupBy("bucket"))
               .applyInArrow(_answer_windows, "block bigint, bucket int, kind int, body binary")
               .unionByName(counts.drop("total", "seen")))
    kind = docs.schema[id_col].dataType.simpleString()
    scored = blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        functools.partial(_answered, blocks, float(total + distinct + 1)),
        f"doc_id {kind}, copies bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, n_bytes bigint")
    scored = scored.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"),
                         "base_score", "score", "n_bytes")
