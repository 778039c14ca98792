"""The queries as SQL, where SQL can express them on whole tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
pos AS (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM d),
win AS (SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM pos),
rep AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT k, count(*) AS n FROM (SELECT DISTINCT k, i + o AS p FROM rep, (VALUES (0), (1), (2)) AS t(o)) GROUP BY k),
lin AS (SELECT k, unnest(string_split(text, chr(10))) AS l FROM d),
dup AS (SELECT k, count(*) - count(DISTINCT l) AS n FROM lin WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY k),
m AS (
  SELECT d.k, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN dup ON dup.k = d.k LEFT JOIN cov ON cov.k = d.k
),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::BIGINT)::BIGINT AS k FROM f GROUP BY source),
r AS (SELECT *, ((k * 1000000) // n)::HUGEINT AS r FROM h),
s AS (SELECT sum(r)::DOUBLE / count(*)::DOUBLE / 1000000 AS mean, sum(r * r)::DOUBLE / count(*)::DOUBLE / 1000000 / 1000000 AS sq FROM r),
v AS (
  SELECT source, CASE WHEN sq - mean * mean <= 0 THEN mean ELSE
    (k + mean * greatest(mean * (1 - mean) / (sq - mean * mean) - 1, 1.0)) / (n + greatest(mean * (1 - mean) / (sq - mean * mean) - 1, 1.0)) END > 0.5 AS bad
  FROM r, s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""


#: State, edit, initial of the role, what the audit gets, cost, state after, what is inserted before, role given.
_EDITS = """
  (0, 'D', '', 'D', 4, 0, '', ''), (1, 'D', '', 'D', 4, 1, '', ''), (2, 'D', '', 'D', 4, 2, '', ''), (3, 'D', '', 'D', 4, 3, '', ''),
  (0, 'K', 's', 'K', 0, 1, '', ''), (0, 'K', 'u', 'K', 0, 2, '', ''), (1, 'K', 'u', 'K', 0, 2, '', ''), (2, 'K', 'a', 'K', 0, 3, '', ''),
  (3, 'K', 'u', 'K', 0, 2, '', ''), (0, 'K', 'a', 'IK', 3, 3, 'user:', ''), (1, 'K', 'a', 'IK', 3, 3, 'user:', ''),
  (2, 'K', 'u', 'IK', 3, 2, 'assistant:', ''), (3, 'K', 'a', 'IK', 3, 3, 'user:', ''),
  (0, 'R', '', 'R', 3, 2, '', 'user'), (1, 'R', '', 'R', 3, 2, '', 'user'), (2, 'R', '', 'R', 3, 3, '', 'assistant'), (3, 'R', '', 'R', 3, 2, '', 'user'),
  (0, 'R', '', 'IR', 6, 3, 'user:', 'assistant'), (1, 'R', '', 'IR', 6, 3, 'user:', 'assistant'),
  (2, 'R', '', 'IR', 6, 2, 'assistant:', 'user'), (3, 'R', '', 'IR', 6, 3, 'user:', 'assistant')
"""

OP12 = rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, '') AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS bytes
  FROM conversations
),
hashed AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda x, b:
    list_reduce(list_prepend(xor(x, b), range(8)), lambda y, i: xor(y >> 1, (y & 1) * 3988292384)))) % 20 AS fate
  FROM src
),
broken AS (
  SELECT key, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE fate <> 0
),
placed AS (SELECT key, turn, role, text, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text) AS i FROM broken),
judged AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY key ORDER BY i) || left(role, 1) AS pair
  FROM placed
),
counted AS (
  SELECT key, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY key
),
edits(state, edit, initial, shown, paid, after, inserted, given) AS (VALUES {_EDITS}),
best AS (
  SELECT key, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS turns FROM counted
  UNION ALL
  SELECT key, i, state, cost, audit, turns FROM (
    SELECT *, row_number() OVER (PARTITION BY key, state ORDER BY cost, audit) AS place FROM (
      SELECT b.key, j.i, e.after AS state, b.audit || e.shown AS audit,
        b.cost + e.paid + CASE WHEN e.edit <> 'D' AND j.fault = 'truncated' THEN 3 ELSE 0 END AS cost,
        list_concat(b.turns, list_concat(CASE WHEN e.inserted = '' THEN [] ELSE [e.inserted] END,
          CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [j.role || ':' || j.text] ELSE [e.given || ':' || j.text] END)) AS turns
      FROM best b JOIN judged j ON j.key = b.key AND j.i = b.i + 1
        JOIN edits e ON e.state = b.state AND (e.edit = 'D' OR j.fault IN ('', 'truncated') AND (e.edit = 'R' OR e.initial = j.initial))
    )
  ) WHERE place = 1
),
closed AS (
  SELECT b.key, cost + len(closing) * 3 AS cost, audit || closing AS audit,
    list_concat(turns, CASE closing WHEN 'II' THEN ['user:', 'assistant:'] WHEN 'I' THEN ['assistant:'] ELSE [] END) AS turns
  FROM (SELECT *, CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS closing FROM best) b JOIN counted c ON c.key = b.key AND c.n = b.i
),
least AS (SELECT * FROM closed QUALIFY row_number() OVER (PARTITION BY key ORDER BY cost, audit) = 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(turns, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, key FROM src) s LEFT JOIN counted USING (key) LEFT JOIN least USING (key)
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_host_quality_rules": OP8, "op12_conversation_repair": OP12}
