"""Rows without ids, rows that share an id, equal rows and clashing column names: nothing is lost, doubled or mixed up."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from laminar.llm import decontamination, mixing, sharding, simhash_dedup, token_files
from laminar.llm.common import running

from test_operators import ascii_lower, brute_matches, check_shards, words_of

SF = "/root/testdata/sf0.001"
CLASH = ("_row", "_k1", "_k2", "class", "before", "total", "_b", "_before", "_at", "_bucket", "_place", "place", "_source", "copies", "nth",
         "key", "key0", "bucket", "id", "fp", "root", "first", "_leak", "_id", "_hash", "position.x", "a`b", "_part")


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """NULL and repeated ids with different texts, equal rows, and columns named like the operators' own."""
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(words_of(r.text)) > 20)
    base = words(1, 60)
    rows = [(None, words(2, 50), "s0"), (None, f"{words(3, 30)} {item} {words(4, 30)}", "s0"), (7, words(5, 50), "s1"), (7, f"{item}", "s1"),
            (8, words(6, 50), None), (9, base, "s1"), (9, base, "s1"), (9, base, "s2"), (None, base, "s1"), (5, base + " z", "s0"),
            (None, words(7, 40), "s2"), (None, words(7, 40), "s2"), (3, None, "s0"), (3, "", None), (None, None, None)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in CLASH]])
    return spark.createDataFrame([(i, t, s, "en", k, *(f"{c}{k % 3}" for c in CLASH)) for k, (i, t, s) in enumerate(rows)], schema), item


def held(df, columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_mixing_and_sharding_keep_every_column(awkward):
    docs, _ = awkward
    placed = mixing.positions(docs)
    assert held(placed, docs.columns) == held(docs, docs.columns)
    for rows in (docs, docs.unionByName(docs)):
        out = sharding.shard(rows, 3)
        assert held(out, rows.columns) == held(rows, rows.columns)
        check_shards(out.collect(), 3)
    mixed = mixing.mixture(docs)
    assert mixed.columns == [*docs.columns, "position"]
    times = Counter()
    for r in placed.collect():
        times[tuple(r[c] for c in docs.columns)] += len(r.times)
    assert held(mixed, docs.columns) == +times


def test_reruns_agree_whatever_the_order_of_rows(spark):
    rows = [(1 if k % 3 else None, words(k % 40, 30), "s") for k in range(120)]       # 40 texts in three copies each
    docs = [spark.createDataFrame(random.Random(s).sample(rows, len(rows)), "doc_id long, text string, source string").repartition(n)
            for s, n in ((1, 1), (2, 5))]
    for run in (lambda d: mixing.mixture(d), lambda d: sharding.shard(d, 4), lambda d: sharding.shard(d, 4, key=("doc_id",))):
        a, b = (sorted(map(tuple, run(d).collect()), key=repr) for d in docs)
        assert a == b


def test_running_sums_of_a_hot_group_are_dealt_over_ranges(spark):
    df = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN CAST(id % 5 AS STRING) END AS g", "id * 7 % 4001 AS o", "id % 11 AS n")
    out = running(df, ["g"], ["o"], "n", "test")
    want = {}
    for g, rows in itertools.groupby(sorted(df.collect(), key=lambda r: (r.g is not None, r.g or "", r.o)), key=lambda r: r.g):
        total = 0
        for r in rows:
            want[g, r.o] = total
            total += r.n
    assert {(r.g, r.o): r.before for r in out.collect()} == want
    assert len({r.g for r in out.collect()}) == 6


def test_near_duplicates_of_any_id_leave_one_row(awkward):
    docs, _ = awkward
    out = simhash_dedup.keep_one(docs)
    assert out.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [simhash_dedup.simhash_of(ascii_lower(t).encode().split(), 3) for _, t in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            group = [group[a] if g == group[b] else g for g in group]
    left = [(r.doc_id, r.text) for r in out.collect()]
    assert len(left) == len(set(group))
    texts = dict(zip(range(len(rows)), (t for _, t in rows), strict=True))
    for g in set(group):
        members = [rows[k] for k in range(len(rows)) if group[k] == g]
        assert sum((i, t) in members for i, t in left) >= 1
        named = [i for i, _ in members if i is not None]
        if named:                                   # the smallest id speaks for the group
            assert any(i == min(named) and (i, t) in members for i, t in left)
    assert len(texts) == docs.count()


def test_only_rows_with_a_leak_go(awkward, spark):
    docs, item = awkward
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = decontamination.decontaminate(docs, items)
    numbered = {k: r.text for k, r in enumerate(docs.collect())}
    leaks = {k for k, _ in brute_matches({k: t or "" for k, t in numbered.items()}, {1: item})}
    assert len(leaks) == 2
    assert held(out, ["n_chars"]) == Counter((k,) for k in numbered if k not in leaks)


def test_the_pipeline_keeps_clean_rows_without_ids(awkward, spark, tmp_path):
    docs, _ = awkward
    rows = [(None if k < 4 else 7, words(100 + k, 40), "en", f"s{k % 2}", k) for k in range(8)]
    clean = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    step = clean
    for name, stage in corpus_pipeline.STAGES[:3]:
        step = stage(spark, step, SF)
        assert held(step, ["n_chars"]) == held(clean, ["n_chars"]), name
    mixed = corpus_pipeline.STAGES[3][1](spark, step, SF)
    assert {r.n_chars for r in corpus_pipeline.STAGES[4][1](spark, mixed, SF).collect()} <= set(range(8))


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint"])
def test_integral_ids_keep_their_type_and_order(spark, tmp_path, kind):
    import public_tokenizers
    docs = spark.createDataFrame([(i, f"text {i}") for i in (10, 2, 9, None)], "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    token_files.write_tokens(docs, f"{tmp_path}/t", public_tokenizers.path("word_bpe_49k.json"))
    found = token_files.read_tokens(spark, f"{tmp_path}/t")
    assert dict(found.dtypes)["doc_id"] == kind
    assert [r.doc_id for r in found.orderBy("start").collect()] == [None, 2, 9, 10]


def test_fingerprints_decide_among_the_opened_windows(spark):
    """The Hamming step drops most windows that share half of the shingles, and none that the exact check accepts."""
    item = words(50, 100)
    v = item.split()
    docs = spark.createDataFrame([(k, " ".join([*words(k, 120).split(), *v[k:], *words(k + 500, 120).split()])) for k in range(0, 60, 3)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    want = {k for k, _ in brute_matches({r.doc_id: r.text for r in docs.collect()}, {1: item})}
    tight, loose = (decontamination.benchmark_matches(docs, items, radius=r, similarity=0.8) for r in (decontamination.RADIUS, 62))
    assert {r.doc_id for r in tight.collect()} == {r.doc_id for r in loose.collect()} == want and 0 < len(want) < 20
    assert {(r.doc_id, r.windows) for r in tight.collect()} == {(r.doc_id, r.windows) for r in loose.collect()}
    exact = decontamination.benchmark_matches(docs, items, radius=0).collect()
    assert [(r.doc_id, r.hamming) for r in exact] == [(0, 0)]
