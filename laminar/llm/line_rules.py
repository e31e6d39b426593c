r"""Line-first cleaning: rules per line, failed lines go, documents that lose too much text are rejected.

A line (split at ``\n``) fails by one of these rules; empty lines never fail:

* punctuation: more than ``MAX_PUNCTUATION`` of its non-space characters are neither letters nor
  digits, or it is a fragment (under ``MIN_WORDS`` words without a closing mark) in a text of several lines;
* navigation: at least ``MIN_SEPARATORS`` words are bare separators, one for every ``WORDS_PER_SEPARATOR`` words;
* boilerplate: it contains a licence, cookie, copyright or script phrase (English, German, French or Spanish).

A document is rejected by the base rules (under 20 words, or more than 30 % of its words in 8-word
windows found twice) or if its failed lines hold more than ``MAX_LOST`` of its words.

Edge cases: NULL and empty texts have no words and fail the base rules; repeated rows give one
row each; an empty table gives no rows; memory is bounded by one batch. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminar.llm.common import text_bytes

MIN_TOTAL_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
MAX_PUNCTUATION, MIN_WORDS, MIN_SEPARATORS, WORDS_PER_SEPARATOR, MAX_LOST = 0.2, 3, 3, 4, 0.5
SYMBOLS = b"#*$%&|<>"
SEPARATORS = frozenset((b"|", b">", b">>", "»".encode(), "·".encode(), "•".encode(), b"/", b"-"))
CLOSING = (b".", b"!", b"?", b":", b";", b'"', b"'", b")", "…".encode(), "»".encode(), "”".encode())
BOILERPLATE = re.compile(
    rb"all rights reserved|licensed under|general public license|terms of (?:use|service)|privacy policy|cookie(?:s| policy)"
    rb"|copyright|\(c\) ?[0-9]{4}|lorem ipsum|javascript|subscribe to our|click here|sign up|log in"
    rb"|alle rechte vorbehalten|nutzungsbedingungen|datenschutzerkl|newsletter abonnieren|hier klicken"
    rb"|tous droits r(?:e|\xc3[\xa9\x89])serv|mentions l(?:e|\xc3[\xa9\x89])gales|politique de confidentialit|conditions d'utilisation|cliquez ici"
    rb"|todos los derechos reservados|pol(?:i|\xc3[\xad\x8d])tica de privacidad|aviso legal|t(?:e|\xc3[\xa9\x89])rminos de uso|haga clic", re.IGNORECASE)
_ASCII_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_SPACES = b" \t\r\x0b\x0c"


def line_fails(line: bytes, words: list[bytes], several: bool) -> bool:
    marks = len(line) - len(line.translate(None, _ASCII_PUNCTUATION))
    solid = sum(map(len, words))
    separators = sum(w in SEPARATORS for w in words) if b" " in line else 0
    return (marks > MAX_PUNCTUATION * solid or several and len(words) < MIN_WORDS and not words[-1].endswith(CLOSING)
            or separators >= MIN_SEPARATORS and separators * WORDS_PER_SEPARATOR >= len(words)
            or BOILERPLATE.search(line) is not None)


def clean_lines(text: bytes) -> tuple[bytes, int]:
    """The text without its failed lines, and the words they held."""
    lines = text.split(b"\n")
    several, kept, lost = len(lines) > 1, [], 0
    for line in lines:
        words = line.split()
        if words and line_fails(line, words, several):
            lost += len(words)
        else:
            kept.append(line)
    return b"\n".join(kept), lost


def repeated_words(words: list[list[bytes]]) -> np.ndarray:
    """Per text the number of words that lie in a WINDOW-word window which occurs at least twice in that text."""
    sizes = np.array([len(w) for w in words], np.int64)
    out = np.zeros(len(words), np.int64)
    if not sizes.sum():
        return out
    flat = np.concatenate([np.array(w, object) for w in words if w])
    text = np.repeat(np.arange(len(words)), sizes)
    ids = pd.factorize(flat)[0].astype(np.int64)
    # ids of windows of 1, 2, 4, 8 words: exact, by pairing the ids of two halves
    width = 1
    while width < WINDOW:
        if len(ids) <= width:
            return out
        pairs = ids[:-width] * (ids.max() + 1) + ids[width:]
        ids = pd.factorize(pairs)[0].astype(np.int64)
        width *= 2
    same = text[:len(ids)] == text[WINDOW - 1:]                    # windows do not cross texts
    at = np.flatnonzero(same)
    seen = pd.Series(ids[at] * len(words) + text[at])
    twice = at[seen.duplicated(keep=False).to_numpy()]
    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    inside = np.cumsum(cover[:-1]) > 0
    return np.bincount(text[inside], minlength=len(words))


def _duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


PARTS = 8 << 20     # bytes of text that are counted together


def evaluate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, base_failed, lost_words, kept and the cleaned text of each row."""
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "lost_words", "kept", "cleaned"]

    def part(ids, texts):
        words = [t.split() for t in texts]
        n = np.array([len(w) for w in words], np.int64)
        # code points: bytes that do not continue another
        chars = [len(t.translate(None, _CONTINUED_AND_SPACE)) for t in texts]
        symbols = [len(t) - len(t.translate(None, SYMBOLS)) for t in texts]
        repeat = repeated_words(words)
        failed = (n < MIN_TOTAL_WORDS) | (100 * repeat > MAX_REPEATED_PERCENT * n)
        cleaned, lost = zip(*map(clean_lines, texts), strict=True)
        lost = np.array(lost, np.int64)
        kept = ~failed & (lost <= MAX_LOST * n)
        columns = [n, chars, symbols, [_duplicate_lines(t) for t in texts], repeat, failed, lost, kept]
        return pa.RecordBatch.from_arrays([ids, *map(pa.array, columns), pa.array([c.decode("utf-8", "replace") for c in cleaned])], names)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            begin = held = 0
            for k, t in enumerate(texts):
                held += len(t)
                if held >= PARTS or k == len(texts) - 1:
                    yield part(batch.column(0).slice(begin, k + 1 - begin), texts[begin:k + 1])
                    begin, held = k + 1, 0
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
              "base_failed boolean, lost_words bigint, kept boolean, cleaned string")
    return docs.select(F.col(id_col).alias("doc_id"), text_bytes(F.col(text_col)).alias("t")).mapInArrow(run, schema)


_CONTINUED_AND_SPACE = bytes(range(0x80, 0xC0)) + b" \t\n\r\x0b\x0c"
