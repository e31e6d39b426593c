r"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Kinds, each matched leftmost and non-overlapping within its kind:

* email, ip (parts at most 255), card (16 to 19 digits, Luhn), phone (8 to 15 digits after a plus),
* iban (two letters, two check digits, up to 30 letters or digits in groups; mod-97),
* ipv6 (colon groups that the standard library's parser takes),
* natid (Spanish identity numbers with their check letter, Brazilian ones with their two check digits),
* secret (the value assigned to a password, key or token; six characters or more, not letters alone).

A match that fails its check is dropped and not retried inside. Only an iban is: the pattern also takes the
capital words and numbers after it, so all ends at its word boundaries are tried (the country's length
first, then the longest), and after a failure the search goes on behind the first group. Every confirmed
span gets a score: a base by kind, plus for words that speak for the kind, minus
for words that speak against it, within ``CONTEXT`` code points on either side.
The four base kinds stay whatever their score (it is returned with each span), the others need ``MIN_SCORE``.

Patterns that would be quadratic on long runs are entered from their rare part: an address from its
at sign, numbers from the start of a run of digits; the matches are the same as of the plain patterns.

Edge cases: NULL and empty texts have no spans; repeated rows give one row each; no row is
dropped; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import ipaddress
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "ipv6", "natid", "secret")
CONTEXT, MIN_SCORE = 40, 0.5
BASE_SCORE = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ipv6": 0.7, "natid": 0.6, "secret": 0.8}
FOR = {
    "email": r"mail|contact|contacto|kontakt|courriel|correo",
    "ip": r"ip|address|host|server|adresse|direcci[oó]n",
    "card": r"card|visa|mastercard|amex|credit|debit|tarjeta|carte|karte|kreditkarte",
    "phone": r"phone|tel|call|mobile|fax|telefon|t[eé]l[eé]phone|tel[eé]fono",
    "iban": r"iban|account|bank|konto|compte|cuenta|bic|swift",
    "ipv6": r"ip|ipv6|address|host|server|adresse|direcci[oó]n",
    "natid": r"dni|nif|cpf|id|identity|identidad|documento|contribuinte",
    "secret": r"login|user|account|credentials?|usuario|benutzer|utilisateur",
}
AGAINST = r"version|build|isbn|release|example|order|serial"
_FOR = {kind: re.compile(rf"\b(?:{words})\b", re.IGNORECASE) for kind, words in FOR.items()}
_AGAINST = re.compile(rf"\b(?:{AGAINST})\b", re.IGNORECASE)

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_DIGIT = re.compile(r"[0-9]")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
_NATID = re.compile(r"(?<![0-9A-Za-z.-])(?:[0-9]{8}-?[A-Z]|[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2})(?![0-9A-Za-z])")
_SECRET = re.compile(r"\b(?:password|passwd|pwd|passphrase|secret|api[_-]?key|access[_-]?key|token|senha|contrase[nñ]a|passwort)"
                     r"[\"']?\x20?[:=]\x20?[\"']?([^\s\"',;]{6,})", re.IGNORECASE)
_DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"      # fixed values: the check letter by the number's remainder modulo 23
_IBAN_LENGTH = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 "
    "GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 "
    "MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SE24 SI19 SK24 SM27 TN24 TR26 UA29 VG24 XK20").split()}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str):
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        # without a domain no start before this sign can match, so the run is used up either way
        at = text.find("@", max(at + 1, free))


def _matches(pattern, check):
    def find(text):
        return [(m.start(), m.end()) for m in pattern.finditer(text) if check(m[0])]
    return find


def _ibans(text: str):
    at = 0
    while m := _IBAN.search(text, at):
        first, size = m[0].find(" "), len(m[0].replace(" ", ""))
        ends = [len(m[0])] + [k for k in range(len(m[0]) - 1, 0, -1) if m[0][k] == " "]
        groups = {end: m[0][:end].replace(" ", "") for end in ends}
        ends.sort(key=lambda end: len(groups[end]) != _IBAN_LENGTH.get(m[0][:2], size))
        good = next((end for end in ends if len(groups[end]) >= 15 and mod97(groups[end])), None)
        if good:
            yield m.start(), m.start() + good
        at = m.start() + (good or (first if first > 0 else len(m[0])))


def ipv6(text: str) -> bool:
    try:
        return len(text) > 3 and bool(ipaddress.IPv6Address(text))
    except ValueError:
        return False


def national_id(text: str) -> bool:
    """Number modulo 23 for the check letter; two digits modulo 11 over all before them."""
    if text[-1].isalpha():
        return _DNI_LETTERS[int(text[:8]) % 23] == text[-1]
    d = [int(c) for c in text if c.isdigit()]
    check = [sum(w * x for w, x in zip(range(n + 1, 1, -1), d, strict=False)) * 10 % 11 % 10 for n in (9, 10)]
    return check == d[9:] and len(set(d)) > 1


def _secrets(text: str):
    return [m.span(1) for m in _SECRET.finditer(text) if not m[1].isalpha()]


def _digits(text: str) -> str:
    return text.replace(" ", "").replace("-", "")


# Digits are ASCII in all patterns, so a long number is compared by length before it is read as an integer.
_FIND = {
    "email": lambda text: list(_emails(text)) if "@" in text else [],
    "ip": _matches(_IP, lambda s: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))),
    "card": _matches(_CARD, lambda s: 16 <= len(d := _digits(s)) <= 19 and luhn(d)),
    "phone": _matches(_PHONE, lambda s: 8 <= len(_DIGIT.findall(s)) <= 15),
    "iban": lambda text: list(_ibans(text)),
    "ipv6": lambda text: _matches(_IPV6, ipv6)(text) if ":" in text else [],
    "natid": _matches(_NATID, national_id),
    "secret": lambda text: _secrets(text) if "=" in text or ":" in text else [],
}


def score(text: str, kind: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - CONTEXT):start]} {text[end:end + CONTEXT]}"
    return round(min(1.0, max(0.0, BASE_SCORE[kind] + 0.2 * bool(_FOR[kind].search(near)) - 0.4 * bool(_AGAINST.search(near)))), 2)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start; positions are code points, the end is exclusive."""
    if not text:
        return []
    spans = [(kind, a, b, score(text, kind, a, b)) for kind in KINDS for a, b in _FIND[kind](text)]
    return [s for s in spans if s[0] in BASE_KINDS or s[3] >= MIN_SCORE]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): the spans of each row's whole text."""
    def run(batches):
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find_spans(t)]
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(SPAN))], ["doc_id", "spans"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in angle brackets; overlapping spans as one, by the first."""
    def masked(text):
        if text is None:
            return None
        out, at = [], 0
        for kind, a, b, _ in sorted(find_spans(text), key=lambda s: (s[1], s[2])):
            if a >= at:
                out += [text[at:a], f"<{kind}>"]
            at = max(at, b)
        return "".join(out) + text[at:]

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([masked(t) for t in batch.column(1).to_pylist()], pa.string())],
                                             ["doc_id", "text"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, text string")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and the span text of each row of ``detect``."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))
    base = of(*BASE_KINDS)
    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"),
                        F.array_join(F.transform("spans", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"))
