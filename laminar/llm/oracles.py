"""DuckDB SQL of the training-data queries that SQL can express (mixing, sharding, line rules, substring dedup, Merkle, divergence)."""

from __future__ import annotations

# Words are runs of anything but the six ASCII white-space characters.
_WORD = r"[^\x20\x09-\x0D]+"

OP3_MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size) * 2.0::DOUBLE AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS class
  FROM d GROUP BY source),
weighed AS (SELECT *, CASE class WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM s),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own_level
  FROM weighed WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
filled AS (
  SELECT *, first_value(CASE WHEN own_level * w <= cap THEN own_level END IGNORE NULLS)
              OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level
  FROM levels),
t AS (SELECT source, source_size, class, coalesce(least(cap, level * w), cap) AS target FROM filled),
placed AS (
  SELECT doc_id, size, source_size, class, target,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)
           - size / 2.0::DOUBLE AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
shares AS (
  SELECT *, middle / nullif(target, 0) AS x0, (middle + source_size) / nullif(target, 0) AS x1 FROM placed)
SELECT doc_id, size, source_size, target,
       CASE WHEN size > 0 THEN size * ((x0 < 1)::BIGINT + (x1 < 1)::BIGINT) ELSE 0 END AS taken,
       round(CASE WHEN size > 0 AND x0 < 1 THEN CASE class
         WHEN 0 THEN 1.5 - sqrt(2.25 - 2 * x0)
         WHEN 1 THEN x0
         ELSE CASE WHEN x0 * 0.9375 <= 0.25 THEN sqrt(0.0625 + 2 * 0.9375 * x0) - 0.25
                   ELSE 0.5 + (sqrt(0.5625 + 5 * (0.9375 * x0 - 0.25)) - 0.75) / 2.5 END END END, 6) AS "position",
       round(CASE WHEN size > 0 AND x1 < 1 THEN CASE class
         WHEN 0 THEN 1.5 - sqrt(2.25 - 2 * x1)
         WHEN 1 THEN x1
         ELSE CASE WHEN x1 * 0.9375 <= 0.25 THEN sqrt(0.0625 + 2 * 0.9375 * x1) - 0.25
                   ELSE 0.5 + (sqrt(0.5625 + 5 * (0.9375 * x1 - 0.25)) - 0.75) / 2.5 END END END, 6) AS position_2
FROM shares
"""

_ROUNDS = 6
_ROUND_STEP = 0x632BE59BD9B4E019
_WRAP = "18446744073709551616::UHUGEINT"
_ROUND_KEY = "CASE step % 6 " + " ".join(
    f"WHEN {r} THEN {(r * _ROUND_STEP + 1) % (1 << 64)}::UHUGEINT" for r in range(_ROUNDS)) + " END"

# The crc32 of whole texts, byte by byte, from a table made by its rule; the Feistel rounds of all
# row numbers as a recursive query that goes on while a number is outside [0, total).
OP4_SHARDING = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
               lambda h: ('0x' || h)::BIGINT)),
             lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM documents, crc),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY left(md5(coalesce(doc_id::VARCHAR, '') || '|' || size || '|' || text_crc32), 3),
                               doc_id NULLS FIRST, size, text_crc32) - 1 AS n
  FROM d),
domain AS (
  SELECT total, half, (1::UHUGEINT << half) - 1 AS mask
  FROM (SELECT count(*)::UHUGEINT AS total, greatest(1, (length(bin(greatest(count(*), 2) - 1)) + 1) // 2)::UHUGEINT AS half FROM d)),
walk AS (
  SELECT n, n::UHUGEINT >> half AS l, n::UHUGEINT & mask AS r, 0 AS step FROM numbered, domain
  UNION ALL
  SELECT n, r, xor(l, xor(z, z >> 31) & mask), step % 6 + 1
  FROM (SELECT n, l, r, step, mask, (xor(y, y >> 27) * 10723151780598845931::UHUGEINT) % {_WRAP} AS z
        FROM (SELECT n, l, r, step, mask, (xor(x, x >> 30) * 13787848793156543929::UHUGEINT) % {_WRAP} AS y
              FROM (SELECT n, l, r, step, mask,
                           (((r + {_ROUND_KEY}) % {_WRAP}) * 11400714819323198485::UHUGEINT) % {_WRAP} AS x
                    FROM walk, domain WHERE step < 6 OR (l << half) + r >= total)))),
places AS (SELECT n, ((l << half) + r)::BIGINT AS place FROM walk, domain WHERE step = 6 AND (l << half) + r < total)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place % 8)::INTEGER AS shard, place // 8 AS slot, NULL::INTEGER AS grown_shard
FROM numbered JOIN places USING (n)
"""

OP5_LINE_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT row, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT row, regexp_extract_all(t, '{_WORD}') AS ws FROM d)),
runs AS (
  SELECT row, i, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lead(w, 4) OVER o AS w4,
         lead(w, 5) OVER o AS w5, lead(w, 6) OVER o AS w6, lead(w, 7) OVER o AS w7
  FROM w WINDOW o AS (PARTITION BY row ORDER BY i)),
found AS (
  SELECT row, i, w7 IS NOT NULL AND count(*) OVER (PARTITION BY row, w, w1, w2, w3, w4, w5, w6, w7) > 1 AS twice FROM runs),
inside AS (
  SELECT row, bool_or(twice) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS within FROM found),
words AS (SELECT row, count(*) AS n_words, count(*) FILTER (within) AS n_repeat_words FROM inside GROUP BY row),
lines AS (
  SELECT row, line, len(all_lines) > 1 AS several, regexp_extract_all(line, '{_WORD}') AS ws
  FROM (SELECT row, string_split(t, chr(10)) AS all_lines, unnest(string_split(t, chr(10))) AS line FROM d)),
judged AS (
  SELECT row, line, len(ws) AS n,
         length(regexp_replace(line, '[^!-/:-@\[-`{{-~]', '', 'g'))
           > 0.2 * octet_length(encode(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')))
         OR several AND len(ws) < 3 AND NOT regexp_matches(ws[-1], '[.!?:;"'')…»”]$')
         OR contains(line, ' ') AND len(list_filter(ws, lambda x: x IN ('|', '>', '>>', '»', '·', '•', '/', '-'))) >= 3
            AND 4 * len(list_filter(ws, lambda x: x IN ('|', '>', '>>', '»', '·', '•', '/', '-'))) >= len(ws)
         OR regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              'all rights reserved|licensed under|general public license|terms of (?:use|service)|privacy policy|cookie'
              || '|copyright|\(c\) ?[0-9]{{4}}|lorem ipsum|javascript|subscribe to our|click here|sign up|log in'
              || '|alle rechte vorbehalten|nutzungsbedingungen|datenschutzerkl|newsletter abonnieren|hier klicken'
              || '|tous droits r[eéÉ]serv|mentions l[eéÉ]gales|politique de confidentialit|conditions d''utilisation|cliquez ici'
              || '|todos los derechos reservados|pol[iíÍ]tica de privacidad|aviso legal|t[eéÉ]rminos de uso|haga clic') AS fails
  FROM lines WHERE len(ws) > 0),
lost AS (
  SELECT row, sum(CASE WHEN fails THEN n ELSE 0 END)::BIGINT AS lost_words, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM judged GROUP BY row),
counts AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(lost_words, 0) AS lost_words
  FROM d LEFT JOIN words USING (row) LEFT JOIN lost USING (row))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost_words <= 0.5 * n_words AS kept
FROM counts
"""

OP11_SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
w AS (SELECT row, doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
windows AS (
  SELECT *, string_agg(w, ' ') OVER o AS k, count(*) OVER o = 20 AS whole
  FROM w WINDOW o AS (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
judged AS (
  SELECT row, i, w, whole AND row_number() OVER (PARTITION BY whole, k ORDER BY doc_id NULLS FIRST, row, i) > 1 AS later FROM windows),
covered AS (
  SELECT row, i, w, bool_or(later) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM judged),
left_over AS (SELECT row, count(*) FILTER (gone) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM covered GROUP BY row)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (row)
"""


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _levels(name: str, start: str) -> str:
    """Every node of the trees over ``start`` (g, pos, node), level by level."""
    return f"""{name} AS (
  SELECT g, 0 AS level, pos, node, count(*) OVER (PARTITION BY g) AS width FROM {start}
  UNION ALL
  SELECT g, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (width + 1) // 2
  FROM {name} WHERE width > 1 GROUP BY g, level, pos // 2, width)"""


# crc32 of the id's text as in the sharding query; g is the language as text that keeps NULL first.
OP12_MERKLE = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl),
d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('v' || lang, 'n') AS g, {_leaf("n_chars")} AS leaf, {_leaf("(n_chars + 1)")} AS altered,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'),
               lambda h: ('0x' || h)::BIGINT)),
             lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 7 = 0 AS tampered
  FROM documents, crc),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS node FROM d),
{_levels("tree", "leaves")},
subroots AS (SELECT '' AS g, g AS member, row_number() OVER (ORDER BY g) - 1 AS pos, node FROM tree WHERE width = 1),
{_levels("top", "subroots")},
heights AS (SELECT g, max(level) AS height FROM tree GROUP BY g),
steps AS (
  SELECT l.row, t.level AS step, (l.pos >> t.level) % 2 AS side, s.node AS sibling
  FROM leaves l JOIN (SELECT DISTINCT g, level, width FROM tree WHERE width > 1) t USING (g)
  LEFT JOIN tree s ON s.g = l.g AND s.level = t.level AND s.pos = xor(l.pos >> t.level, 1)
  UNION ALL
  SELECT l.row, height + t.level, (r.pos >> t.level) % 2, s.node
  FROM leaves l JOIN heights h USING (g) JOIN subroots r ON r.member = l.g
  CROSS JOIN (SELECT DISTINCT level, width FROM top WHERE width > 1) t
  LEFT JOIN top s ON s.level = t.level AND s.pos = xor(r.pos >> t.level, 1)),
folded AS (
  SELECT row, 0 AS step, CASE WHEN tampered AND altered IS NOT NULL THEN altered ELSE leaf END AS digest FROM d
  UNION ALL
  SELECT f.row, f.step + 1, sha256(CASE WHEN sibling IS NULL THEN digest WHEN side = 1 THEN sibling || digest ELSE digest || sibling END)
  FROM folded f JOIN steps s ON s.row = f.row AND s.step = f.step),
ends AS (SELECT row, arg_max(digest, step) AS folded_root FROM folded GROUP BY row),
proof AS (SELECT row, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM steps GROUP BY row)
SELECT doc_id, leaf, s.node AS subroot, r.node AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = r.node AS verified
FROM d JOIN subroots s ON s.member = d.g JOIN (SELECT node FROM top WHERE width = 1) r ON true
JOIN ends USING (row) LEFT JOIN proof USING (row)
"""

_P = "(1 + 1000000000::HUGEINT * ({n} + 2) // ({total} + 2 * v))::BIGINT"

OP13_DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT row, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY ALL HAVING count(DISTINCT row) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (
  SELECT g.lang, g.source, k.term, k.lang_n, v, lang_total, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang)
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, {_P.format(n="n", total="total")} AS p, {_P.format(n="lang_n", total="lang_total")} AS q FROM counts),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 10
"""

ORACLES = {"op3_mixing": OP3_MIXING, "op4_sharding": OP4_SHARDING, "op5_line_rules": OP5_LINE_RULES, "op11_substring_dedup": OP11_SUBSTRING_DEDUP,
           "op12_merkle": OP12_MERKLE, "op13_divergence": OP13_DIVERGENCE}
