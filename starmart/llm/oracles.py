"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from starmart.llm.quality import (BOILERPLATE, BOILERPLATE_WORDS, DECORATION, END_MARK, SEPARATOR,
                                  SYMBOL_CLASS)

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

OP2 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
    md5('0:' || coalesce(doc_id::VARCHAR, '')) AS draw
  FROM documents),
s AS (
  SELECT source, source_size,
    ([5.0, 2.0, 1.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
fill(step, level) AS (
  SELECT 0, 0.0::DOUBLE
  UNION ALL
  SELECT step + 1, (
    SELECT greatest(0.0, sum(source_size) * 1.5::DOUBLE
        - coalesce(sum(source_size * 2.0::DOUBLE) FILTER (source_size * 2.0::DOUBLE <= weight * level), 0.0))
      / sum(weight) FILTER (source_size * 2.0::DOUBLE > weight * level)
    FROM s)
  FROM fill WHERE step <= (SELECT count(*) FROM s) AND level IS NOT NULL),
t AS (
  SELECT source, source_size, least(source_size * 2.0::DOUBLE, weight * level) AS target,
    CASE WHEN source_size > 0 THEN floor(least(source_size * 2.0::DOUBLE, weight * level) / source_size) ELSE 0 END AS whole
  FROM s, (SELECT max(level) AS level FROM fill)),
r AS (
  SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS part,
    coalesce(sum(size) OVER (PARTITION BY t.source ORDER BY draw, doc_id NULLS LAST, size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN part > 0 AND before + size * 0.5 <= part THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""

OP3 = f"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
    sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, first_value(len) OVER w AS keep_len,
    count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY len DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, (doc_id IS NOT DISTINCT FROM keep_id AND len = keep_len) AS kept, text_sha256
FROM g
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _count(column: str, pattern: str) -> str:
    return f"len(regexp_extract_all({column}, {_quoted(pattern)}))"


OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
line AS (
  SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM d),
judged AS (
  SELECT row_id, line, {_count('line', _WORD)} AS n_words,
    length(regexp_replace(line, '{_SPACE}', '', 'g')) AS chars,
    {_count('line', SEPARATOR)} AS n_sep, {_count('line', DECORATION)} AS n_deco,
    {_count('line', SYMBOL_CLASS)} AS n_symbols,
    regexp_matches(regexp_replace(line, '{_SPACE}+\\z', ''), {_quoted(END_MARK)}) AS ended,
    regexp_matches(line, {_quoted(BOILERPLATE)}) AS boiler
  FROM line),
lines AS (
  SELECT row_id, sum(chars) FILTER (n_words > 0 AND NOT (
      (n_words >= 5 OR ended) AND NOT (n_sep >= 3 AND n_sep * 10 > n_words)
      AND NOT (n_deco >= 3 AND n_deco * 4 > n_words) AND NOT (n_words <= {BOILERPLATE_WORDS} AND boiler)
      AND n_symbols <= chars * 0.1::DOUBLE)) AS lost,
    count(line) FILTER (n_words > 0) - count(DISTINCT line) FILTER (n_words > 0) AS n_dup_lines
  FROM judged GROUP BY row_id),
word AS (
  SELECT row_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT row_id, regexp_extract_all(text, '{_WORD}') AS ws FROM d)),
win AS (
  SELECT row_id, i, word, lead(word, 1) OVER o AS word2, lead(word, 2) OVER o AS word3
  FROM word WINDOW o AS (PARTITION BY row_id ORDER BY i)),
again AS (
  SELECT row_id, i FROM win WHERE word3 IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY row_id, word, word2, word3) > 1),
rep AS (
  SELECT row_id, count(DISTINCT j) AS n
  FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY row_id),
m AS (
  SELECT doc_id, {_count('text', _WORD)}::BIGINT AS n_words,
    length(regexp_replace(text, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
    {_count('text', SYMBOL_CLASS)}::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d JOIN lines USING (row_id) LEFT JOIN rep USING (row_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND lost <= word_chars * 0.5::DOUBLE) AS kept
FROM b
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STRIPPED = f"regexp_replace(regexp_replace(line, '^{_SPACE}+', ''), '{_SPACE}+$', '')"

OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT row_id, doc_id, i, line, translate({_STRIPPED}, '{_UPPER}', '{_LOWER}') AS key
  FROM (SELECT row_id, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d)),
held AS (SELECT DISTINCT key, doc_id FROM line WHERE length(key) >= 10),
repeated AS (SELECT key, first(doc_id ORDER BY doc_id NULLS LAST) AS first_id FROM held GROUP BY key HAVING count(*) >= 2)
SELECT line.doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (repeated.key IS NOT NULL AND line.doc_id IS DISTINCT FROM first_id)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
    FILTER (repeated.key IS NULL OR line.doc_id IS NOT DISTINCT FROM first_id), '')) AS kept_sha256
FROM line LEFT JOIN repeated USING (key)
GROUP BY row_id, line.doc_id
"""

_BYTES = "octet_length(encode(coalesce(html, '')))"

OP11 = f"""
WITH p AS (
  SELECT page_id, {_BYTES}::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
    row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST) AS place,
    first_value(page_id) OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST) AS first_id
  FROM pages)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN place > 1 AND payload_bytes >= 100 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN place > 1 AND payload_bytes >= 100 THEN first_id END AS refers_to
FROM p
"""

OP12 = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws
  FROM documents),
l AS (
  SELECT doc_id AS label_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic
  FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
    + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY sha256(text)), false)::INT AS mask
  FROM d LEFT JOIN l ON d.doc_id = l.label_id),
h AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a JOIN f b ON b.letter <> a.letter JOIN f c ON c.letter NOT IN (a.letter, b.letter)
    JOIN f d ON d.letter NOT IN (a.letter, b.letter, c.letter)
    JOIN f e ON e.letter NOT IN (a.letter, b.letter, c.letter, d.letter)),
s AS (
  SELECT filter_order, step::INT AS step, bits[step] AS bit,
    coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
  FROM o, unnest([1, 2, 3, 4, 5]) AS t(step)),
r AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER ((mask & (earlier + bit)) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER ((mask & bit) > 0 AND (mask & earlier) = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER ((mask & bit) > 0 AND (mask & earlier) > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER ((mask & bit) > 0 AND (mask & earlier) = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER ((mask & bit) > 0 AND (mask & earlier) = 0), 0)::BIGINT AS toxic_lost
  FROM h, s GROUP BY part, filter_order, step, bit)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""

ORACLE_SQL = {"op2_mix_sources": OP2, "op3_exact_dedup": OP3, "op6_quality_rules": OP6,
              "op8_line_dedup": OP8, "op11_warc": OP11, "op12_filter_audit": OP12}
