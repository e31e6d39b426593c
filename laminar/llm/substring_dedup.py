"""Substring deduplication with a count-min prefilter.

A window is ``window`` consecutive words of one document. Every word covered by a window whose words also start
earlier (in an earlier document, or earlier in the same one) is removed; windows are judged on the input.

1. Anchors. A window's anchor is the smallest hash among its ``gram``-word runs (leftmost of equals), so equal
   windows have equal anchors, and neighbouring windows mostly share theirs. A window occurs at most as often
   as its anchor.
2. Count-min. Each task counts its anchors' cells in a sketch of ``DEPTH`` rows of 4-bit counters and sends only the
   counted cells, per slice of the sketch. Slices are summed up in a tree of ``FAN_IN`` and the merged sketch is broadcast; its
   size follows the corpus up to ``max_sketch_bytes``, the proven bound. The smallest counter of an anchor never
   lies below its true count, nor below the count of any window anchored there. A fuller sketch lets more
   windows through to step 3 and never loses one.
3. Exact pass. Windows whose anchor is estimated repeated are grouped by a 96-bit digest of their words (among 10^13 different
   windows two share one with a chance of 1 in 1,000). Runs of windows with
   one anchor travel as one row, dealt out by the anchor; where the anchor's counter is full (it may be a very
   common phrase in different surroundings) each window travels alone, dealt out by its own digest. Of equal windows
   that a task meets in one flush only the first is sent, so a group of copies, however large, costs a row per flush.
   The first occurrence of each window stays; the starts of the others go back to their documents.

Order: by id (NULL first), then by a hash of id and text. Equal rows count as one document in step 3; at the end one
of them gets its words, the others none.

Edge cases: NULL, empty and short texts (fewer words than a window) lose nothing; of repeated rows one
keeps its words; a very long text is hashed and judged as a whole; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laminar.llm.common import materialise

WINDOW, GRAM, DEPTH, FAN_IN, SLICES, FULL, DIGEST = 20, 10, 2, 32, 16, 15, 12
FLUSH_WINDOWS, CHUNK_BYTES = 400_000, 1 << 20
_M = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word in some bytes of text."""
    space = _SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    ends = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
    lengths = ends - starts
    letters = data[~space]
    begins = np.cumsum(lengths) - lengths
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(lengths.max()), _M))
        place = np.arange(len(letters)) - np.repeat(begins, lengths)
        return _mix(np.add.reduceat(_BYTE[letters] * power[place], begins) + lengths.astype(np.uint64)), starts


class Anchors:
    """Anchors of a chunk of texts: for each run of neighbouring windows with one anchor its hash, its text's place in the
    chunk, its first window and the number of its windows; and the words of each text."""

    def __init__(self, texts: list[bytes], window: int, gram: int):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        hashes, starts = word_hashes(np.frombuffer(b" ".join(texts) + b" ", np.uint8))
        begins = np.searchsorted(starts, np.cumsum(sizes) - sizes)          # first word of each text
        self.words = np.diff(np.append(begins, len(starts)))
        self.hash, self.text, self.first, self.windows = np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
        total, n = len(hashes), len(hashes) - gram + 1
        if total < window:
            return
        with np.errstate(over="ignore"):
            grams = np.zeros(n, np.uint64)
            for j in range(gram):
                grams = grams * _M + hashes[j:j + n]
            grams = _mix(grams)
        # smallest of ``window - gram + 1`` neighbours, leftmost of equals: hash in the upper, place in the lower half
        key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        span, width = 1, window - gram + 1
        while span < width:
            step = min(span, width - span)
            key = np.minimum(key[:len(key) - step], key[step:])
            span += step
        text = np.repeat(np.arange(len(texts)), self.words)
        at = np.flatnonzero(text[:total - window + 1] == text[window - 1:])     # windows inside one text
        if not len(at):
            return
        place, text = (key[at] & np.uint64(0xFFFFFFFF)).astype(np.int64), text[at]
        run = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]))))
        self.hash, self.text, self.windows = grams[place[run]], text[run], np.diff(np.append(run, len(at)))
        self.first = at[run] - begins[self.text]


def chunks(texts: pa.Array):
    """(first place, texts) in chunks of about CHUNK_BYTES."""
    begin, held, size = 0, [], 0
    for k, text in enumerate(texts):
        held.append(text.as_buffer().to_pybytes())
        size += len(held[-1])
        if size >= CHUNK_BYTES:
            yield begin, held
            begin, held, size = k + 1, [], 0
    if held:
        yield begin, held


def cells(anchor: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each anchor in each row of the sketch; rows lie behind one another."""
    with np.errstate(over="ignore"):
        return [(_mix(anchor + np.uint64(row) * _M) & np.uint64(width - 1)).astype(np.int64) + row * width for row in range(DEPTH)]


def read_cells(sketch: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (sketch[at >> 1] >> ((at & 1) << 2).astype(np.uint8)) & 15


def estimate(sketch: np.ndarray, anchor: np.ndarray, width: int) -> np.ndarray:
    """At least the count of each anchor, FULL standing for FULL and more."""
    found = [read_cells(sketch, at) for at in cells(anchor, width)]
    return np.minimum.reduce(found)


def sketch_width(text_bytes: int, max_sketch_bytes: int) -> int:
    """Counters of a row: a power of two, two or more per expected anchor (a sixth of the words), within the bound."""
    width, most = 1 << 14, max_sketch_bytes * 2 // DEPTH
    while width * 2 <= most and width < text_bytes // 15:
        width *= 2
    return width


def _pack(at: np.ndarray, counts: np.ndarray) -> bytes:
    steps = np.diff(at, prepend=0).astype(np.uint32)
    return zlib.compress(len(at).to_bytes(8, "little") + steps.tobytes() + counts.astype(np.uint8).tobytes(), 1)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(data)
    n = int.from_bytes(raw[:8], "little")
    return np.cumsum(np.frombuffer(raw, np.uint32, n, 8).astype(np.int64)), np.frombuffer(raw, np.uint8, n, 8 + 4 * n)


def _counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted cells with their counts, FULL at most."""
    at = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts]).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, counts = at[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else np.zeros(0, np.int64)
    return at[first], np.minimum(np.add.reduceat(counts, first), FULL) if len(at) else counts


def build_sketch(texts: DataFrame, width: int, window: int, gram: int) -> np.ndarray:
    """The merged sketch over all windows' anchors: DEPTH x ``width`` counters, two in a byte."""
    per_slice = width * DEPTH // SLICES

    def count(batches):
        from pyspark import TaskContext
        part, parts, size = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                at = np.sort(np.concatenate(cells(Anchors(texts, window, gram).hash, width)))
                parts.append((at, np.ones(len(at), np.uint8)))
                size += len(at)
                if size > 8 * FLUSH_WINDOWS:
                    parts, size = [_counted(parts)], 0
        if parts:
            at, counts = _counted(parts)
            cut = np.searchsorted(at, np.arange(SLICES + 1) * per_slice)
            rows = [(s, _pack(at[a:b] - s * per_slice, counts[a:b])) for s, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int32()), pa.array([part] * len(rows), pa.int32()),
                                              pa.array([d for _, d in rows], pa.binary())], names=["slice", "part", "data"])

    def merge(table: pa.Table) -> pa.Table:
        at, counts = _counted([_unpack(x) for x in table.column("data").to_pylist()])
        return pa.table({"slice": table.column("slice")[:1], "part": table.column("part")[:1], "data": pa.array([_pack(at, counts)], pa.binary())})

    schema = "slice int, part int, data binary"
    parts = materialise(texts.mapInArrow(count, schema), "sketch")      # texts: one column, no NULL
    most = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while most > 1:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("slice", "part").applyInArrow(merge, schema)
        most = -(-most // FAN_IN)
    sketch = np.zeros(width * DEPTH // 2, np.uint8)
    for row in parts.collect():             # SLICES rows, together as large as the sketch at most
        at, counts = _unpack(bytes(row["data"]))
        at = at + row["slice"] * per_slice
        for half, shift in ((0, 0), (1, 4)):
            own = (at & 1) == half
            sketch[at[own] >> 1] |= (counts[own] << shift).astype(np.uint8)
    return sketch


def _digests(data: bytes) -> np.ndarray:
    """Digests of DIGEST bytes as rows of two numbers."""
    wide = np.zeros((len(data) // DIGEST, 16), np.uint8)
    wide[:, :DIGEST] = np.frombuffer(data, np.uint8).reshape(-1, DIGEST)
    return wide.view(np.uint64)


class _Flush:
    """The windows of some documents that are estimated repeated: start, digest and the key that deals them out."""

    def __init__(self, window: int):
        self.window, self.docs, self.blocks, self.keys, self.n = window, [], [], set(), 0

    def add(self, doc: tuple, text: bytes, anchor, first, windows, counts) -> None:
        if doc[1:] in self.keys:                # an equal row
            return
        self.keys.add(doc[1:])
        words = text.split()
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.repeat(first - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
        begins, stops = np.where(starts > 0, ends[starts - 1], 0), ends[starts + self.window - 1] - 1
        digest = xxhash.xxh3_128_digest
        digests = _digests(b"".join([digest(joined[a:b])[:DIGEST] for a, b in zip(begins.tolist(), stops.tolist(), strict=True)]))
        self.blocks.append((starts, digests, np.where(np.repeat(counts >= FULL, windows), digests[:, 0], np.repeat(anchor, windows))))
        self.docs.append(doc)
        self.n += len(starts)


def _first_of_equals(digest: np.ndarray, rank: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each window is the first, by (rank, start), of those with its digest; the windows come in that order."""
    order = np.argsort(digest[:, 0], kind="stable")
    ordered, same = digest[order], np.zeros(len(order), bool)
    same[1:] = (ordered[1:] == ordered[:-1]).all(axis=1)
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))      # place of the first of the run
    first = np.empty(len(order), bool)
    rank, start = rank[order], start[order]
    first[order] = (rank == rank[head]) & (start == start[head])
    return first


def _ranked(docs: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of rows (id, k1, k2): their sorted places, and in that order a number that equal rows share."""
    order = pc.sort_indices(docs, [("id", "ascending"), ("k1", "ascending"), ("k2", "ascending")], null_placement="at_start").to_numpy()
    keys = np.stack([docs.column(c).to_numpy()[order] for c in ("k1", "k2")])
    return order, np.cumsum(np.concatenate(([0], (keys[:, 1:] != keys[:, :-1]).any(axis=0))))


_SENT = ("bucket", "id", "k1", "k2", "starts", "digests")


def _rows(id_type: pa.DataType, flush: _Flush, buckets: int) -> pa.RecordBatch:
    """Rows for the exact pass: one per document and bucket with the first windows of this flush, and one with the
    starts that an earlier window of this flush makes superfluous (no digests)."""
    docs = pa.table({"id": pa.array([d[0] for d in flush.docs], id_type), "k1": pa.array([d[1] for d in flush.docs], pa.int64()),
                     "k2": pa.array([d[2] for d in flush.docs], pa.int64())})
    order, rank = _ranked(docs)
    start, digest, key = (np.concatenate([flush.blocks[k][i] for k in order]) for i in range(3))
    doc = np.repeat(order, [len(flush.blocks[k][0]) for k in order])
    rank = np.repeat(rank, [len(flush.blocks[k][0]) for k in order])
    first = _first_of_equals(digest, rank, start)
    bucket = np.where(first, (_mix(key) % np.uint64(buckets)).astype(np.int64), doc % buckets)
    group = (bucket * 2 + first) * len(order) + doc
    by = np.argsort(group, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], group[by[1:]] != group[by[:-1]])))
    heads, spans = by[cut], list(zip(cut.tolist(), np.append(cut[1:], len(by)).tolist(), strict=True))
    starts, digests = start[by].astype(np.int32).tobytes(), digest[by].view(np.uint8).reshape(-1, 16)[:, :DIGEST].tobytes()
    rows = docs.take(pa.array(doc[heads]))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[heads], pa.int32()), *[rows.column(c).combine_chunks() for c in ("id", "k1", "k2")],
         pa.array([starts[4 * a:4 * b] for a, b in spans], pa.binary()),
         pa.array([digests[DIGEST * a:DIGEST * b] if sends else b"" for (a, b), sends in zip(spans, first[heads].tolist(), strict=True)], pa.binary())],
        names=_SENT)


def kept_words(words: list[bytes], starts: np.ndarray, window: int) -> list[bytes]:
    """The words outside all windows that begin at ``starts``."""
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]


def _strings(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary()).cast(pa.string())


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
          max_sketch_bytes: int = 64 << 20, bucket_bytes: int = 2 << 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): one row per row of ``docs``, ``kept`` being the words left, joined by one space."""
    if not 1 <= gram <= window:
        raise ValueError("gram is 1 to window")
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = plain.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    width, buckets = sketch_width(size, max_sketch_bytes), max(1, -(-size // bucket_bytes))
    sketch = docs.sparkSession.sparkContext.broadcast(build_sketch(plain.select("text"), width, window, gram))
    id_type = plain.schema["id"].dataType.simpleString()
    # a 128-bit key of the row's content; NULL and other ids differ by the second part
    keyed = plain.select("id", F.xxhash64("id", "text").alias("k1"), F.xxhash64(F.col("id").isNull(), "id", "text").alias("k2"), "text")

    def windows(batches):
        flush, kind = _Flush(window), None
        for batch in batches:
            kind = batch.schema.field("id").type
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("id", "k1", "k2")), strict=True))
            for begin, texts in chunks(batch.column("text")):
                found = Anchors(texts, window, gram)
                counts = estimate(sketch.value, found.hash, width)
                own = np.flatnonzero(counts > 1)
                text = found.text[own]
                cut = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1]))) if len(own) else own
                for part in np.split(own, cut[1:]) if len(own) else ():
                    k = int(found.text[part[0]])
                    flush.add(keys[begin + k], texts[k], found.hash[part], found.first[part], found.windows[part], counts[part])
                    if flush.n > FLUSH_WINDOWS:
                        yield _rows(kind, flush, buckets)
                        flush = _Flush(window)
        if flush.n:
            yield _rows(kind, flush, buckets)

    def repeated(table: pa.Table) -> pa.Table:
        sent = pc.greater(pc.binary_length(table.column("digests")), 0)
        known, table = table.filter(pc.invert(sent)), table.filter(sent)
        out = {c: known.column(c).to_pylist() for c in ("k1", "k2", "starts")}
        if table.num_rows:
            order, rank = _ranked(table)
            table = table.take(pa.array(order))
            start = np.frombuffer(b"".join(table.column("starts").to_pylist()), np.int32)
            digest = _digests(b"".join(table.column("digests").to_pylist()))
            owner = np.repeat(np.arange(table.num_rows), pc.binary_length(table.column("starts")).to_numpy() // 4)
            later = ~_first_of_equals(digest, rank[owner], start)
            cut = np.searchsorted(owner[later], np.arange(table.num_rows + 1))
            data, some = start[later].tobytes(), np.flatnonzero(cut[1:] > cut[:-1])
            for c in ("k1", "k2"):
                out[c] += table.column(c).to_numpy()[some].tolist()
            out["starts"] += [data[4 * cut[k]:4 * cut[k + 1]] for k in some.tolist()]
        return pa.table({"k1": pa.array(out["k1"], pa.int64()), "k2": pa.array(out["k2"], pa.int64()), "starts": pa.array(out["starts"], pa.binary())})

    sent = keyed.mapInArrow(windows, f"bucket int, id {id_type}, k1 bigint, k2 bigint, starts binary, digests binary")
    marks = (sent.groupBy("bucket").applyInArrow(repeated, "k1 bigint, k2 bigint, starts binary")
             .groupBy("k1", "k2").agg(F.collect_list("starts").alias("starts")))

    def short(batches):
        for batch in batches:
            own = [(k, words) for k, words in ((k, t.as_buffer().to_pybytes().split()) for k, t in enumerate(batch.column("text"))) if len(words) < window]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array([k for k, _ in own], pa.int64())), pa.array([len(w) for _, w in own], pa.int64()),
                 pa.array([0] * len(own), pa.int64()), _strings([b" ".join(w) for _, w in own])], names=["doc_id", "n_words", "n_removed", "kept"])

    def long(batches):
        """The first of this task's equal rows with its text, one more row without for all others."""
        seen: dict[tuple, list] = {}
        names, kind = ["id", "k1", "k2", "n_words", "copies", "text"], None
        for batch in batches:
            kind, rows = batch.schema.field("id").type, []
            n = [len(t.as_buffer().to_pybytes().split()) for t in batch.column("text")]
            for k, (key, words) in enumerate(zip(zip(*(batch.column(c).to_pylist() for c in ("k1", "k2")), strict=True), n, strict=True)):
                if words < window:
                    continue
                if key in seen:
                    more = seen[key] = seen[key] or [batch.column("id")[k].as_py(), words, 0]
                    more[2] += 1
                else:
                    seen[key] = None
                    rows.append(k)
            part = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names[:3]], pa.array([n[k] for k in rows], pa.int64()),
                                              pa.array([1] * len(rows), pa.int64()), part.column("text")], names=names)
        if more := [(key, x) for key, x in seen.items() if x]:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for _, x in more], kind), *[pa.array([key[i] for key, _ in more], pa.int64()) for i in (0, 1)],
                 *[pa.array([x[i] for _, x in more], pa.int64()) for i in (1, 2)], pa.nulls(len(more), pa.string())], names=names)

    def rebuilt(batches):
        for batch in batches:
            removed, kept = [], []
            for text, starts, n in zip(*(batch.column(c) for c in ("text", "starts", "n_words")), strict=True):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                if starts.is_valid:
                    words = kept_words(words, np.unique(np.frombuffer(b"".join(starts.as_py()), np.int32)), window)
                removed.append(n.as_py() - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), pa.array(removed, pa.int64()), _strings(kept)],
                                             names=["doc_id", "n_words", "n_removed", "kept"])

    out = f"doc_id {id_type}, n_words bigint, n_removed bigint, kept string"
    rows = (keyed.mapInArrow(long, f"id {id_type}, k1 bigint, k2 bigint, n_words bigint, copies bigint, text string")
            .join(marks, ["k1", "k2"], "left"))
    # at most two rows of a task share a key: a repeated row gets its words once, its other copies none
    nth = F.row_number().over(W.partitionBy("k1", "k2").orderBy(F.col("text").isNull()))
    once = (rows.withColumn("extra", nth > 1)
            .withColumns({"text": F.when(~F.col("extra"), F.col("text")), "starts": F.when(~F.col("extra"), F.col("starts"))})
            .select("id", "n_words", "text", "starts", "extra", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))))
    return plain.mapInArrow(short, out).unionByName(once.mapInArrow(rebuilt, out))


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of ``dedup``'s rows."""
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
