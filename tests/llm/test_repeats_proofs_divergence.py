"""Substring dedup, Merkle manifest and source divergence against brute force, and on awkward tables."""

import binascii
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laminar.llm import divergence, merkle, queries, substring_dedup

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       # names that the operators also use
                       *[T.StructField(c, T.StringType()) for c in ("row", "id", "idx", "node", "n", "term", "_group", "bucket", "claim2")]])
CLASH = ("clash",) * 9


def _long(k, n=300):
    rng = random.Random(k)
    return " ".join(rng.choice("ab bc cd de ef fg gh hi ij jk é xü".split()) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    shared = _long(1, 45)
    rows = [(1, None, "en", "s0", 3), (2, "", None, None, None), (3, " \t\n", "", "s1", 0), (4, shared, "en", "s1", 5), (4, shared, "en", "s1", 5),
            (5, f"{_long(2)} {shared}\x0b{_long(3)}", "en", "s0", 9), (None, shared, "en", "s0", None), (None, None, None, "s0", 1), (None, None, None, "s0", 1),
            (6, f"{_long(2)}\n{_long(2)}", "de", "s0", 1), (6, "other A b C", "de", "s1", 1), (7, "w " * 70, "de", "s2", 2), (8, "x" * 50_000, "de", None, 2),
            (9, _long(9, 20_000), "fr", "s1", 2), (10, _long(9, 19), "fr", "s0", 2), (11, _long(9, 20), "fr", "s0", 2)]
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def tuples(df, *cols):
    return sorted(((tuple(r[c] for c in cols)) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- 11 substring dedup

def brute_dedup(rows, window):
    """rows: (id, text, hash); rows of one id are ordered by the operator's hash, equal rows in any order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    seen, out = set(), []
    for doc, text, _ in rows:
        words = WORDS.findall(text or "")
        covered = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if key in seen:
                covered[i:i + window] = [True] * window
            seen.add(key)
        kept = [w for w, c in zip(words, covered, strict=True) if not c]
        out.append((doc, len(words), len(words) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def check_dedup(docs, **options):
    rows = [(r.doc_id, r.text, r.h) for r in docs.select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("h")).collect()]
    found = substring_dedup.digest(substring_dedup.dedup(docs, **options))
    assert tuples(found, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_dedup(rows, options.get("window", 20))


def test_dedup_equals_brute_force(small, awkward, empty):
    check_dedup(small)
    check_dedup(awkward)
    assert substring_dedup.dedup(empty).count() == 0


def test_a_full_sketch_and_tiny_flushes_lose_nothing(small, awkward, monkeypatch):
    check_dedup(awkward, max_sketch_bytes=64, bucket_bytes=2_000)
    monkeypatch.setattr(substring_dedup, "sketch_width", lambda size, most: 16)          # every window is estimated repeated
    check_dedup(small, bucket_bytes=50_000)
    check_dedup(awkward.repartition(5), window=5, gram=3)
    check_dedup(awkward, window=1, gram=1)


def test_repeated_rows_over_many_tasks_keep_their_words_once(spark):
    docs = spark.createDataFrame([(1 if i % 2 else None, _long(i % 2, 50)) for i in range(101)], "doc_id long, text string").repartition(9)
    check_dedup(docs)


def test_text_ids_and_many_copies(spark):
    text = _long(5, 60)
    docs = spark.createDataFrame([(f"d{i:03d}", text if i % 3 else f"{text} tail {i}") for i in range(200)], "doc_id string, text string").repartition(7)
    rows = tuples(substring_dedup.dedup(docs), "doc_id", "n_removed", "kept")
    assert rows[0] == ("d000", 0, f"{text} tail 0")
    # "tail" too ends a window of d000
    assert all(kept == ("" if i % 3 else str(i)) for i, (_, _, kept) in enumerate(rows) if i)


def test_estimates_never_lie_below_the_count():
    rng = np.random.default_rng(3)
    found = rng.integers(0, 300, 5_000).astype(np.uint64)
    width, sketch = 64, np.zeros(32 * substring_dedup.DEPTH, np.uint8)
    at = np.concatenate(substring_dedup.cells(found, width))
    at, counts = substring_dedup._counted([(at, np.ones(len(at), np.uint8))])
    for half, shift in ((0, 0), (1, 4)):
        own = at & 1 == half
        sketch[at[own] >> 1] |= (counts[own] << shift).astype(np.uint8)
    true = Counter(found.tolist())
    values = np.array(sorted(true), np.uint64)
    assert (substring_dedup.estimate(sketch, values, width) >= np.minimum([true[int(v)] for v in values], 15)).all()


# ---------------------------------------------------------------- 12 Merkle manifest

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows, fanout=2):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r):
        return h("".join(map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]))))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h("".join(levels[-1][i:i + fanout])) for i in range(0, len(levels[-1]), fanout)])
        return levels

    def path(levels, at):
        for nodes in levels[:-1]:
            start = at - at % fanout
            yield nodes[start:at], nodes[at + 1:start + fanout]
            at //= fanout

    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append((leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[1]["doc_id"] is not None, x[1]["doc_id"] or 0, x[0]))
        trees[g] = tree([x[0] for x in groups[g]])
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (own, r) in enumerate(groups[g]):
            steps = [*path(trees[g], i), *path(top, k)]
            doc = r["doc_id"]
            bad = doc is not None and binascii.crc32(str(doc).encode()) % 7 == 0 and r["n_chars"] is not None
            claim = leaf(r | {"n_chars": r["n_chars"] + 1}) if bad else own
            for before, after in steps:
                claim = h("".join([*before, claim, *after]))
            sha = h("".join(x for pair in steps for part in pair for x in part))
            out.append((doc, own, trees[g][-1][0], top[-1][0], sha, claim, claim == top[-1][0]))
    return sorted(out, key=repr)


def found_manifest(docs, **options):
    leaves = merkle.tampered_leaves(docs)
    manifest = merkle.build(leaves, "lang", ["doc_id"], **options)
    return tuples(merkle.verify(merkle.proofs(manifest, ["doc_id", "claim"])), "doc_id", "leaf", "subroot", "root", "proof_sha256",
                  "folded_root", "verified")


@pytest.mark.parametrize("fanout, every", [(2, 10), (2, 2), (3, 1), (5, 3)])
def test_manifest_equals_brute_force(small, awkward, fanout, every):
    for docs in (awkward, small):
        rows = [r.asDict() for r in docs.collect()]
        assert found_manifest(docs, fanout=fanout, every=every) == brute_manifest(rows, fanout)


def test_manifest_of_empty_and_single_tables(empty, small, spark):
    assert found_manifest(empty) == []
    one = small.limit(1)
    row = one.collect()[0].asDict()
    assert found_manifest(spark.createDataFrame([row], small.schema)) == brute_manifest([row])


def test_only_every_few_levels_are_written(small):
    manifest = merkle.build(merkle.tampered_leaves(small), "lang", ["doc_id"], every=3)
    nodes = [level.count() for level in manifest.groups]
    assert nodes[0] == small.count() and nodes[-1] == small.select("lang").distinct().count()
    assert all(b <= a // 8 + 4 for a, b in itertools.pairwise(nodes))


# ---------------------------------------------------------------- 13 divergence

def brute_audit(rows, min_docs=10, top=10):
    found = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    groups, docs_with = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in found.findall(text or "")]
        groups[lang or "", source or ""].update(terms)
        docs_with[lang or ""].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs_with[lang].items() if n >= min_docs]
        own = {s: {t: c[t] for t in kept} for (x, s), c in groups.items() if x == lang}

        def p_of(counts, kept=kept):
            total = sum(counts.values())
            return {t: 1 + 1_000_000_000 * (n + 2) // (total + 2 * len(kept)) for t, n in counts.items()}

        whole = p_of({t: sum(c[t] for c in own.values()) for t in kept})
        p = {s: p_of(c) for s, c in own.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, f(p[s][t], whole[t])) for t in kept if own[s][t] > 0 and p[s][t] > whole[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(ranked if part == "pair" else ranked[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"min_docs": 1, "block_groups": 2, "block_terms": 7}, {"min_docs": 3, "block_groups": 3, "block_terms": 100, "top": 2}])
def test_audit_equals_brute_force(small, awkward, options):
    only = {k: v for k, v in options.items() if k in ("min_docs", "top")}
    for docs in (small, awkward):
        rows = [tuple(r) for r in docs.select("lang", "source", "text").collect()]
        assert tuples(divergence.audit(docs, **options), "lang", "source", "part", "item", "value", "rank") == brute_audit(rows, **only)


def test_audit_of_an_empty_table(empty):
    assert divergence.audit(empty).count() == 0


def test_queries_return_their_columns(spark):
    assert queries.op11_substring_dedup(spark, SF).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert set(queries.op12_merkle(spark, SF).columns) == {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"}
    assert dict(queries.op13_divergence(spark, SF).dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string",
                                                              "value": "bigint", "rank": "int"}
