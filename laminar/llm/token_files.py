"""Token ids in byte-aligned variable-length files, with ids ranked by frequency.

Writing. Documents are dealt into ranges of ascending id, tokenized, and staged as chunks of whole
documents (about ``CHUNK_BYTES`` of text each). Ids are counted over all chunks; the most frequent id
gets code 0, and so on. A code takes 1 to 4 bytes, little end first; the lengths (2 bits each, four
to a control byte) stand apart from the data bytes, so a table of 256 entries decodes four
lengths at once and numpy gathers the codes without a loop.

Files: a Parquet folder ``chunks`` with one row per chunk: part, chunk, doc_ids, and the payload
``b"RVB1"``, documents, ids (uint32 each), ids per document (uint32 each), control bytes,
data bytes; and a folder ``ranks`` with the id of each code (bounded by the vocabulary).
Spark's writer commits both, so they live on any file system that the cluster shares.

Reading. ``read_tokens`` decodes the payloads; a document's ``start`` is the number of ids before it: chunk
sizes are summed up over parts and inside parts, the payloads do not move for it.

Edge cases: NULL and empty texts are just the end id; NULL ids sort first; equal ids are ordered by text and
stay separate documents; an empty table gives empty folders and no rows; a very long text is one
document of one chunk. Other columns are ignored.
"""

from __future__ import annotations

import functools
import json
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

END_ID, CHUNK_BYTES, MAGIC = 1, 1 << 22, b"RVB1"
CACHE_WORDS = 600_000                             # entries a worker remembers, some 150 bytes each
_PLAIN_TAIL = ".,;:!?*&$%#|)]}\""
#: Tokenizers of this shape treat words between ASCII white space apart and drop case; others get whole texts.
_WORD_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORD_SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)   # by control byte


def encode_codes(codes: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of non-negative codes below 2^32."""
    codes = np.ascontiguousarray(codes, "<u4")
    length = 1 + (codes > 0xFF).astype(np.uint8) + (codes > 0xFFFF) + (codes > 0xFFFFFF)
    padded = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    padded[:len(codes)] = length - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    used = np.arange(4) < length[:, None]
    return control.tobytes(), codes.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_codes(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` codes, by table lookup of four lengths per control byte."""
    length = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    at = np.cumsum(length) - length
    raw = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)))
    out = np.zeros(n, np.uint32)
    for k in range(4):
        out |= np.where(length > k, raw[np.minimum(at + k, len(raw) - 1)], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


def pack(sizes: np.ndarray, codes: np.ndarray) -> bytes:
    control, data = encode_codes(codes)
    head = np.array([len(sizes), len(codes)], "<u4").tobytes() + np.asarray(sizes, "<u4").tobytes()
    return MAGIC + head + control + data


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids per document, codes) of a payload."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token payload")
    docs, n = np.frombuffer(payload, "<u4", 2, 4).tolist()
    sizes = np.frombuffer(payload, "<u4", docs, 12)
    begin = 12 + 4 * docs
    middle = begin + -(-n // 4)
    return sizes.astype(np.int64), decode_codes(payload[begin:middle], payload[middle:], n)


@functools.cache
def staged_kind(path: str) -> str:
    """Type of staged ids: two bytes if the whole vocabulary fits."""
    from tokenizers import Tokenizer
    return "<u2" if max(Tokenizer.from_file(path).get_vocab().values()) < 1 << 16 else "<u4"


def splits_words(tokenizer_json: str) -> bool:
    """Whether a tokenizer is of the shape that the word cache supports."""
    shape = json.loads(tokenizer_json)
    model, added = shape["model"], shape.get("added_tokens") or []
    return (shape.get("normalizer") == _WORD_NORMALIZER and shape.get("pre_tokenizer") == _WORD_SPLIT
            and model.get("type") == "BPE" and not model.get("dropout")
            # special tokens are looked for inside words that hold "<|"
            and all("<|" in t["content"] and not any(c.isspace() for c in t["content"])
                    and not any(t.get(k) for k in ("normalized", "single_word", "lstrip", "rstrip")) for t in added))


def split_marks(words: pa.StringArray) -> tuple[pa.StringArray, pa.StringArray]:
    """Each word's core, in lower case if the word is ASCII, and the ASCII marks after its last letter ("": none).

    Other words keep their case: the tokenizer composes (NFC) before it drops case, and some letters are composed in lower case only.
    Words with ``<|`` stay whole and in their case: special tokens are matched before case is dropped.
    """
    lowered = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
    bare = pc.utf8_rtrim(lowered, _PLAIN_TAIL)
    cut = pc.and_(pc.match_substring_regex(bare, r"\p{L}$"), pc.invert(pc.match_substring(words, "<|")))
    core = pc.if_else(cut, bare, pc.if_else(pc.match_substring(words, "<|"), words, lowered))
    size = pc.binary_length(lowered).to_numpy() - pc.binary_length(core).to_numpy()
    ends = pc.binary_length(lowered).to_numpy().cumsum()
    data = np.frombuffer(lowered.buffers()[2] or b"", np.uint8)   # a new array: it begins with its first word
    past = size.cumsum()
    marks = data[np.repeat(ends - past, size) + np.arange(past[-1] if len(past) else 0)]
    offsets = np.concatenate(([0], past)).astype(np.int32)
    return core, pa.StringArray.from_buffers(len(words), pa.py_buffer(offsets), pa.py_buffer(marks))


class WordEncoder:
    """Ids of whole texts by the tokenizers library, remembering the ids of words.

    Words are remembered only where words between ASCII white space are tokenized apart (the tokenizer drops white space
    before it looks at words) and case is dropped (``splits_words``); other tokenizers get whole texts. The case of ASCII words
    and ASCII marks after a last letter are split off first, which cannot change the ids; what is left is tokenized once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = splits_words(self.tokenizer.to_str())
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.kind = staged_kind(path)
        self.kind_code = "H" if self.kind == "<u2" else "I"
        self.known: dict[str, bytes] = {"": b""}

    def _ids(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _letter_ids(self, word: str) -> bytes:
        """Ids of lower-case ASCII letters: normalising and splitting leave such a word as it is."""
        return array(self.kind_code, [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()

    def look_up(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as bytes; new words are tokenized and remembered."""
        if len(self.known) > CACHE_WORDS:
            self.known = {"": b""}
        known = self.known
        new = [w for w in words if w not in known]
        plain = [w for w in new if w.isascii() and w.isalpha() and w.islower()]
        known.update(zip(plain, map(self._letter_ids, plain), strict=True))
        other = [w for w in new if w not in known]
        known.update(zip(other, self._ids(other), strict=True))
        return [known[w] for w in words]

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, ids of all texts), each text followed by ``end``."""
        if not self.by_words:
            tail = np.array([end], self.kind).tobytes()
            found = [ids + tail for ids in self._ids(texts.to_pylist())]
            return np.fromiter(map(len, found), np.int64, len(found)) // len(tail), np.frombuffer(b"".join(found), self.kind)
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        core, marks = (x.dictionary_encode() for x in split_marks(words.dictionary))
        found = self.look_up(core.dictionary.to_pylist()) + self.look_up(marks.dictionary.to_pylist())
        found.append(np.array([end], self.kind).tobytes())
        length = np.fromiter(map(len, found), np.int64, len(found)) // np.dtype(self.kind).itemsize
        pool, begin = np.frombuffer(b"".join(found), self.kind), np.cumsum(length) - length
        # pieces of the texts in order: each word's core and marks, and the end after a text's last word
        pieces = np.stack((core.indices.to_numpy(), marks.indices.to_numpy() + len(core.dictionary)))[:, words.indices.to_numpy()]
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        at = np.insert(pieces.T.ravel(), 2 * offsets[1:], len(found) - 1)
        n = length[at]
        past = np.cumsum(n)
        ids = pool[np.repeat(begin[at] - past + n, n) + np.arange(past[-1] if len(past) else 0)]
        return np.diff(past[2 * offsets[1:] + np.arange(len(texts))], prepend=0), ids


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker: Spark's tasks reuse workers, and with them the words they know."""
    return WordEncoder(path)


def slices(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of whole texts of about ``most`` bytes: a run ends with the text that reaches it."""
    out, begin, held = [], 0, 0
    for k, n in enumerate(sizes.tolist()):
        held += n
        if held >= most or k == len(sizes) - 1:
            out.append((begin, k + 1))
            begin, held = k + 1, 0
    return out


# Ids of these types keep their type and order; others are kept as text, in code point order.
INTEGERS = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}


def _stage(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Chunks in order: (part, chunk, doc_ids, n_tokens, sizes, ids as little-endian bytes)."""
    kind = docs.schema["doc_id"].dataType
    arrow_kind = INTEGERS.get(kind.simpleString(), pa.string())

    def run(batches):
        import os

        from pyspark import TaskContext
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known, part, chunk = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            doc_ids, texts = batch.columns
            for a, b in slices(pc.binary_length(texts).to_numpy(), CHUNK_BYTES):
                sizes, ids = known.encode(texts[a:b], end_id)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([chunk], pa.int32()),
                     pa.array([doc_ids[a:b].to_pylist()], pa.list_(arrow_kind)), pa.array([len(ids)], pa.int64()),
                     pa.array([sizes.astype("<u4").tobytes()], pa.binary()), pa.array([ids.tobytes()], pa.binary())],
                    ["part", "chunk", "doc_ids", "n_tokens", "sizes", "ids"])
                chunk += 1

    ordered = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    return ordered.mapInArrow(run, f"part int, chunk int, doc_ids array<{kind.simpleString()}>, n_tokens bigint, sizes binary, ids binary")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenize ``docs`` and write the files under ``path`` (a new folder all executors share)."""
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if named.schema["doc_id"].dataType.simpleString() not in INTEGERS:
        named = named.withColumn("doc_id", F.col("doc_id").cast("string"))
    # chunk rows are large: few of them belong into one batch
    staged = _stage(named, tokenizer_path, end_id)
    staged.write.parquet(f"{path}/staged")
    staged = spark.read.schema(staged.schema).parquet(f"{path}/staged")

    wide = staged_kind(tokenizer_path)

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch.column(0):
                seen = np.bincount(np.frombuffer(data.as_buffer(), wide))
                if len(seen) > len(total):
                    seen, total = total, seen
                total[:len(seen)] += seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    # one row per id of the vocabulary and task, then per id: a bounded table
    ranked = (staged.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
              .select("id", "n", (F.row_number().over(W.orderBy(F.desc("n"), "id")) - 1).alias("code")))
    ranked.write.parquet(f"{path}/ranks")
    id_of = _ids_by_code(spark, path)
    code_of = np.zeros(int(id_of.max()) + 1 if len(id_of) else 1, np.uint32)
    code_of[id_of] = np.arange(len(id_of), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(code_of)             # bounded by the vocabulary

    def encode(batches):
        for batch in batches:
            payloads = [pack(np.frombuffer(s.as_buffer(), "<u4"), shared.value[np.frombuffer(d.as_buffer(), wide)])
                        for s, d in zip(batch.column(4), batch.column(5), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(payloads, pa.binary())],
                                             ["part", "chunk", "doc_ids", "n_tokens", "payload"])
    kind = named.schema["doc_id"].dataType.simpleString()
    staged.mapInArrow(encode, f"part int, chunk int, doc_ids array<{kind}>, n_tokens bigint, payload binary").write.parquet(f"{path}/chunks")


def _ids_by_code(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.schema("id bigint, code int").parquet(f"{path}/ranks").toPandas()
    return rows.sort_values("code")["id"].to_numpy(np.int64)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids as uint32 little-endian bytes), decoded from the files under ``path``."""
    files = spark.read.parquet(f"{path}/chunks")
    sizes = files.select("part", "chunk", "n_tokens")
    # one row per part: parts are at most the shuffle partitions of the writing job
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    past = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(past), F.lit(0)).alias("before"))
    inside = W.partitionBy("part").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = (sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
              .join(parts, F.col("part") == F.col("p"))
              .select(F.col("part").alias("p"), F.col("chunk").alias("c"), (F.col("before") + F.col("inside")).alias("begin")))
    id_of = spark.sparkContext.broadcast(_ids_by_code(spark, path).astype("<u4"))     # bounded by the vocabulary
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches):
        for batch in batches:
            for doc_ids, payload, begin in zip(*batch.columns, strict=True):
                n, codes = unpack(payload.as_py())
                ids, ends = id_of.value[codes], np.cumsum(n)
                raw = ids.tobytes()
                cut = [raw[4 * a:4 * b] for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([doc_ids.values, pa.array(begin.as_py() + ends - n, pa.int64()), pa.array(cut, pa.binary())],
                                                 ["doc_id", "start", "ids"])
    placed = files.join(starts, (F.col("part") == F.col("p")) & (F.col("chunk") == F.col("c"))).select("doc_ids", "payload", "begin")
    return placed.mapInArrow(decode, f"doc_id {kind}, start bigint, ids binary")


def digest(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of ``read_tokens``."""
    return tokens.select("doc_id", "start", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


