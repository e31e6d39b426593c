"""Cases of the second review: inputs on which an operator once did less than the whole job."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from laminar.llm import decontamination, pii, ppm, token_files, toxicity
from laminar.llm.common import text_bytes


# ---------------------------------------------------------------- 9 toxicity

def weak_word_corpus():
    """Every tenth text is toxic; "bastard" is in most of these, the weak word "damned" in some of either class (15 % of them toxic)."""
    rows = []
    for i in range(8_000):
        toxic = i % 10 == 0
        words = [f"filler{i % 7}", "ordinary"]
        words += ["bastard"] * (toxic and i % 50 != 0)
        words += ["damned"] * (i % 50 == 0 or (not toxic and i % 63 < 9 and i % 10 < 8))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_decision_does_not_depend_on_the_sample_sizes(spark, monkeypatch):
    rows = weak_word_corpus()
    weak = [t for _, w, t in rows if "damned" in w and "bastard" not in w]
    assert 0.1 < np.mean(weak) < 0.2
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    asked = spark.createDataFrame([(1, "ordinary damned"), (2, "ordinary"), (3, "ordinary bastard")], "doc_id long, text string")
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 10_000)
    monkeypatch.setattr(toxicity, "MAX_CLEAN", 10_000)
    want = toxicity.fit(docs, labels)
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 600)
    monkeypatch.setattr(toxicity, "MAX_CLEAN", 600)            # the sample is half toxic, the labels a tenth
    got = toxicity.fit(docs, labels)
    for model in (want, got):
        assert {r.doc_id: r.toxic for r in toxicity.score(asked, model).collect()} == {1: False, 2: False, 3: True}
    assert abs(want["thresholds"][0] - got["thresholds"][0]) < 0.7


# ---------------------------------------------------------------- 10 decontamination

def brute_matches(docs, items, similarity=0.8):
    """As in test_operators, and a document of fewer words than the item is one window."""
    found = {}
    for d, t in docs.items():
        w = t.lower().split()
        for i, b in items.items():
            v = b.lower().split()
            n, k = min(len(v), len(w)), min(5, len(v))
            item = Counter(tuple(v[j:j + k]) for j in range(len(v) - k + 1))
            for s in range(len(w) - n + 1):
                window = Counter(tuple(w[j:j + k]) for j in range(s, s + n - k + 1))
                share = sum((item & window).values()) / sum((item | window).values())
                if share >= similarity - 1e-12:
                    found[d, i] = max(found.get((d, i), 0), share)
    return found


def default_matches(spark, docs, items):
    return {(r.doc_id, r.item_id): r.similarity for r in decontamination.benchmark_matches(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string"),
        spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()}


def test_documents_shorter_than_the_item_are_one_window(spark):
    rng = random.Random(21)
    words = [f"w{i}" for i in range(400)]
    items = {i: " ".join(rng.choices(words, k=n)) for i, n in enumerate((15, 16, 23, 40, 59, 59, 3, 6))}
    docs = {}
    for i, b in items.items():
        v = b.split()
        for cut in range(1, min(14, len(v))):
            docs |= {1000 * i + 10 * cut: " ".join(v[:-cut]), 1000 * i + 10 * cut + 1: " ".join(v[cut:]), 1000 * i + 10 * cut + 2: " ".join(v[cut // 2:len(v) - (cut + 1) // 2])}
        changed = v[:-1]
        changed[len(changed) // 2] = "changed"
        docs |= {1000 * i + 900: " ".join(changed), 1000 * i + 901: b + " and more"}
    got, want = default_matches(spark, docs, items), brute_matches(docs, items)
    assert set(got) == set(want) and (4090, 4) in want
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_the_default_radius_keeps_windows_with_a_repeated_shingle(spark):
    rng = random.Random(22)
    words = [f"w{i}" for i in range(5_000)]
    items = {i: " ".join(rng.choices(words, k=n)) for i, n in enumerate((49, 94, 200, *[900] * 20))}
    docs = {}
    for i, b in items.items():
        v = b.split()
        for k, part in enumerate((10, 18)):
            tail = (len(v) - 4) // part
            docs[10 * i + k] = " ".join(["before", *v[:len(v) - tail], *["la"] * tail])
    got, want = default_matches(spark, docs, items), brute_matches(docs, items)
    assert set(got) == set(want) and len(want) == len(docs)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


# ---------------------------------------------------------------- 2 personal data

def test_iban_before_capitals_and_numbers():
    plain, grouped = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    for before in ("IBAN ", "", "REF AB12 ", "IBAN AB12 CDEF "):
        for iban in (plain, grouped, "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"):
            for after in ("", " BIC COBADEFFXXX", " EUR 50", " 2024", " A", " AND " + "X" * 40, " or 12", "\n2024"):
                spans = [s[:3] for s in pii.find_spans(before + iban + after) if s[0] == "iban"]
                assert spans == [("iban", len(before), len(before + iban))], (before, iban, after)
    two = [s[1:3] for s in pii.find_spans(f"{grouped} {plain} 2024") if s[0] == "iban"]
    assert two == [(0, len(grouped)), (len(grouped) + 1, len(grouped) + 1 + len(plain))]
    assert not [s for s in pii.find_spans("IBAN DE88 3704 0044 0532 0130 00") if s[0] == "iban"]


# ---------------------------------------------------------------- 8 token files

ODD = ["Hello World  two\n\nlines", "H̱ALLO J̌x T̈. Y̊, W̊", "ÉTÉ Été. ΣΑΣ İ", "<|ENDOFTEXT|> a<|endoftext|>B. c", "", "̸ a̸= ≠ 12.5%."]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_word_cache_equals_the_tokenizer(name):
    path = public_tokenizers.path(name)
    library, ours = Tokenizer.from_file(path), token_files.WordEncoder(path)
    sizes, ids = ours.encode(pa.array(ODD), 1)
    want = [library.encode(t, add_special_tokens=False).ids + [1] for t in ODD]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    assert ours.by_words == (name == "word_bpe_49k.json")


# ---------------------------------------------------------------- 7 language model

def test_copies_of_one_row_do_not_share_a_block_beyond_its_size(spark):
    hot = [(None, "one text that comes again and again " * 3)] * 400 + [(7, "another hot text, 0123456789 " * 4)] * 300
    rows = hot + [(1000 + i, f"text {i} of its own, {i * i}") for i in range(300)] + [(5, None), (5, None), (6, "held in two copies")] + [(6, "held in two copies")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    blocked, blocks = ppm.dealt(frame.select("doc_id", text_bytes(F.col("text")).alias("t")), 7, 2, 4_000)
    held = blocked.groupBy("block").agg(F.sum(F.length("t") + 1).alias("size")).collect()
    assert blocks > 10 and max(r["size"] for r in held) < 3 * 4_000
    assert blocked.agg(F.sum("copies")).first()[0] == len(rows)
    value = lambda r: (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6), r.n_bytes)
    few, one = (Counter(map(value, ppm.score(frame, block_bytes=b).collect())) for b in (4_000, 1 << 30))
    assert few == one and sum(few.values()) == len(rows)


def test_added_kinds_are_checked():
    spans = lambda text: [(k, text[a:b]) for k, a, b, _ in pii.find_spans(text) if k in ("ipv6", "natid", "secret")]
    assert spans("host 2001:db8::8a2e:370:7334 and ::1:2, at 12:30:45 or a::b::c") == [("ipv6", "2001:db8::8a2e:370:7334"), ("ipv6", "::1:2")]
    assert spans("DNI 12345678Z, DNI 12345678A, CPF 529.982.247-25, CPF 529.982.247-24, CPF 111.111.111-11") == [
        ("natid", "12345678Z"), ("natid", "529.982.247-25")]
    assert spans('password=hunter22; api_key: "sk-1234567890" token = abc password: required') == [("secret", "hunter22"), ("secret", "sk-1234567890")]
    assert pii.find_spans("example order 4111 1111 1111 1111")[0][3] == 0.4 < pii.find_spans("visa card 4111 1111 1111 1111")[0][3]


def test_mask_and_scores(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd now, password=hunter22!"), (2, None), (3, "")], "doc_id int, text string")
    assert [tuple(r) for r in pii.mask(docs).orderBy("doc_id").collect()] == [(1, "mail <email> now, password=<secret>"), (2, None), (3, "")]
    rows = {r.doc_id: r for r in pii.digest(pii.detect(docs)).collect()}
    assert rows[1].scores == "1.00,0.80" and rows[1].n_secret == 1 and rows[2].scores == rows[3].scores == ""


def test_samples_of_repeated_ids_are_the_same_in_each_run(spark):
    from laminar.llm import quality, toxicity
    rng = random.Random(4)
    rows = [(i % 40, " ".join(rng.choices("good text with some words. bad hateful idiot stuff".split(), k=30))) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(40)], "doc_id long, quality int, t boolean").withColumn("toxic", F.col("t").cast("int"))
    docs = [spark.createDataFrame(random.Random(s).sample(rows, len(rows)), "doc_id long, text string").repartition(p) for s, p in ((1, 2), (2, 7))]
    a, b = (quality.fit(d, labels) for d in docs)
    assert a == b
    a, b = (toxicity.fit(d, labels) for d in docs)
    assert a == b


def test_hot_byte_pairs_are_split_without_changing_a_score(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = lambda: sorted((r.doc_id, r.held_out, round(r.score, 6)) for r in ppm.score(docs).collect())
    want = rows()
    monkeypatch.setattr(ppm, "HOT_WINDOWS", 40)
    monkeypatch.setattr(ppm, "GROUP_WINDOWS", 2_000)
    assert rows() == want
    monkeypatch.setattr(ppm, "HOT_WINDOWS", 0)              # every pair
    assert rows() == want
