"""DuckDB SQL for the registered queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

SQL = {
    "op2_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
  SELECT *, regexp_matches(role || ' ' || text, '</?s>|\[/?INST\]') OR starts_with(role, '~') AS coded,
    length(role) + length(text) AS plain,
    length(regexp_replace(role || text, '[~<\[]', 'xx', 'g')) AS escaped
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN coded THEN escaped + 1 ELSE plain END + length('<s>[INST][/INST]</s>')) AS BIGINT) AS formatted_chars,
  true AS verified
FROM marked GROUP BY conv_id
""",
    "op7_quality_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, text FROM d),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line
),
line_counts AS (SELECT doc_id, sum(n) AS n_lines, sum(n - 1) AS dup FROM lines GROUP BY doc_id),
m AS (
  SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM words LEFT JOIN covered ON covered.doc_id = words.doc_id LEFT JOIN line_counts ON line_counts.doc_id = words.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM m
""",
    "op10_warc": r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT *, sha1(b) AS d, octet_length(b) AS n, max(page_id) OVER (PARTITION BY b) AS head FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < head THEN head END AS refers_to
FROM h
""",
    "op12_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
numbers AS (
  SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d
), cut AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, substring(text, 1, a) AS p, substring(text, a + 1, b - a) AS m, substring(text, b + 1, n - b) AS s FROM cut
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
""",
}
