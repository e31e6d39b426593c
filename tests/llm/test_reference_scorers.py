"""Plain Python scorers of the fitted quality and toxicity models over whole texts, compared with Spark row by row."""

import binascii
import math
import re

import pytest
from pyspark.sql import functions as F

from laminar.llm import quality, toxicity

SF = "/root/testdata/sf0.01"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SPACE = "\t\n\x0b\x0c\r "


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, " \n\t"), (-4, "ÉTÉ!! stupid word " * 50), (-5, "a" * 3000), (-6, "|||\n\n# A B! $x\x0b1\n# A B! $x")],
                                "doc_id long, text string")
    return docs.unionByName(odd), spark.read.parquet(f"{SF}/labels.parquet")


def words_of(text):
    return [w for w in re.split(f"[{SPACE}]+", text) if w]


def statistics(text):
    """The documented statistics, by counting characters one at a time; sizes are UTF-8 bytes."""
    size = lambda s: len(s.encode())
    words = words_of(text)
    out = dict.fromkeys(quality.STATISTICS, 0.0) | {"log_bytes": math.log(1 + size(text))}
    if not words:
        return out
    n, solid = len(words), sum(map(size, words))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    share = lambda test: sum(size(c) for c in text if test(c)) / solid
    return out | {
        "log_words": math.log(1 + n), "word_length": solid / n, "upper": share(lambda c: "A" <= c <= "Z"), "digits": share(lambda c: "0" <= c <= "9"),
        "symbols": share(lambda c: c in "#*$%&|<>"), "bangs": text.count("!") / n, "pipes": text.count("|") / n, "marks": share(lambda c: c in MARKS),
        "other_bytes": share(lambda c: ord(c) > 127), "distinct_words": len(set(words)) / n, "top_word": max(map(words.count, set(words))) / n,
        "adjacent": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, "repeated_lines": 1 - len(set(lines)) / len(lines),
        "line_words": n / len(lines), "closed_lines": sum(x.rstrip(SPACE)[-1] in ".!?" for x in lines) / len(lines),
        # upper case and no lower case among the ASCII letters
        "shout_words": sum(any("A" <= c <= "Z" for c in w) and not any("a" <= c <= "z" for c in w) for w in words) / n,
        "marked_words": sum(w[-1] in "#*$%&!" for w in words) / n}


def test_quality_scores(tables):
    docs, labels = tables
    model = quality.fit(docs, labels)
    assert len(model) > 3
    found = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert found.keys() == texts.keys()
    for doc, text in texts.items():
        s = statistics(text)
        total = 0.0
        for rule, weight in model:
            if all(s[quality.STATISTICS[j]] <= edge if sign == "<=" else s[quality.STATISTICS[j]] > edge for j, sign, edge in rule):
                total += weight
        assert abs(found[doc] - 1 / (1 + math.exp(-total))) < 1e-9, doc


def test_toxicity_scores(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    assert len(model["weights"]) > 3
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    t1, t2 = model["thresholds"]
    clean = {r.doc_id for r in toxicity.keep_clean(docs, model).select("doc_id").collect()}
    seen = 0
    for r in docs.collect():
        features = set()
        for word in set(words_of("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or ""))):
            core = word.strip(MARKS).encode()
            if len(core) >= 3:
                named = [core, b"4:" + core[:4]] + [b"5:" + core[:5]] * (len(core) >= 5)
                features |= {binascii.crc32(f) // 2 ** (32 - toxicity.SPACE_BITS) for f in named}
        x = sum(model["weights"].get(f, 0.0) for f in features)
        at_least = [1 / (1 + math.exp(t - x)) for t in (t1, t2)]
        chance = [1 - at_least[0], at_least[0] - at_least[1], at_least[1]]
        row = rows[r.doc_id]
        assert abs(row.severity - sum(at_least)) < 1e-9
        assert abs(max(chance) - chance[row.grade]) < 1e-9
        assert row.toxic == (at_least[0] >= toxicity.REJECT) and (r.doc_id in clean) == (not row.toxic)
        seen += row.toxic
    assert 0 < seen < len(rows) / 2 and docs.filter(F.col("doc_id") < 0).count() == 6
