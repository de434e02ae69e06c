"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lowered(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


def _edit(state: str, cost: str, letter: str, row: str | None) -> str:
    """The state after an edit that adds ``row`` to what is repaired, or nothing."""
    out = f"{state}.o" if row is None else f"list_append({state}.o, {row})"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {out}}} END"


def _inserted(state: str, *roles: str) -> str:
    for role in roles:
        state = _edit(f"({state})", "5", "I", f"'{role}:'")
    return state


_RAW = "STRUCT(c BIGINT, a VARCHAR, o VARCHAR[])"
_ROW, _TRUNCATED = "d.role || ':' || d.text", "CASE WHEN d.fault = 'truncated' THEN 5 ELSE 0 END"


def _kept(state: str, initial: str) -> str:
    return f"CASE WHEN d.initial = '{initial}' AND d.fault NOT IN ('blank', 'duplicate') THEN {_edit(state, _TRUNCATED, 'K', _ROW)} END"


def _reroled(state: str, role: str) -> str:
    return f"CASE WHEN d.fault NOT IN ('blank', 'duplicate') THEN {_edit(state, f'1 + {_TRUNCATED}', 'R', f"'{role}:' || d.text")} END"


def _deleted(state: str) -> str:
    return _edit(state, "2", "D", None)


#: Each conversation's cheapest (cost, audit, rows) by state, row by row; equal costs by least audit.
TURN_REPAIR = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_transform(range(0, 8 * length(s)), lambda i: (ascii(s[i // 8 + 1]) >> (i % 8)::INT) & 1),
      lambda crc, x: xor(crc >> 1, 3988292384 * (xor(crc, x) & 1)), 4294967295)) % 20 AS kind
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations)
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, (VALUES (0), (1)) AS copies(n) WHERE kind <> 0 AND (n = 0 OR kind = 3)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i, substr(role, 1, 1) AS initial
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged)
), d AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS two
  FROM numbered
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM d GROUP BY conv_id
), start AS (SELECT {{'c': 0, 'a': '', 'o': []}}::{_RAW} AS s0), step(conv_id, i, s0, s1, s2, s3) AS (
  SELECT sums.conv_id, 0::BIGINT, s0, NULL::{_RAW}, ({_inserted("s0", "user")})::{_RAW},
    ({_inserted("s0", "user", "assistant")})::{_RAW}
  FROM sums, start
  UNION ALL
  SELECT conv_id, i, r0, r1, least(r2, {_inserted("r0", "user")}, {_inserted("r1", "user")}, {_inserted("r3", "user")}),
    least(r3, {_inserted("r2", "assistant")}, {_inserted("r0", "user", "assistant")}, {_inserted("r1", "user", "assistant")})
  FROM (
    SELECT d.conv_id, d.i, {_deleted("s0")} AS r0, least({_deleted("s1")}, {_kept("s0", "s")}) AS r1,
      least({_deleted("s2")}, {", ".join(f"{_kept(s, 'u')}, {_reroled(s, 'user')}" for s in ("s0", "s1", "s3"))}) AS r2,
      least({_deleted("s3")}, {_kept("s2", "a")}, {_reroled("s2", "assistant")}) AS r3
    FROM step JOIN d ON d.conv_id IS NOT DISTINCT FROM step.conv_id AND d.i = step.i + 1
  )
), best AS (
  SELECT sums.*, least(s0, s3) AS b FROM step JOIN sums ON sums.conv_id IS NOT DISTINCT FROM step.conv_id AND sums.n = step.i
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
  sha256(coalesce(array_to_string(b.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
"""

#: All phrases of one to five words, counted one by one; 128-bit integers.
COLLOCATIONS = f"""
WITH p AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, {_lowered("coalesce(text, '')")} AS text FROM documents)
), g AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM p, range(1, 6) AS ks(k) WHERE len(words) >= k)
), f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL), n AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k >= 2 AND f >= 100), cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, n, (1000::HUGEINT * c.a * n // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (
    SELECT lang, phrase, a, cut, array_to_string(words[:cut], ' ') AS head, array_to_string(words[cut + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)
  ) AS c JOIN f AS l ON l.lang = c.lang AND l.phrase = head JOIN f AS r ON r.lang = c.lang AND r.phrase = rest JOIN n ON n.lang = c.lang
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1), inner_parts AS (
  SELECT DISTINCT lang, array_to_string(words[i:i + size - 1], ' ') AS phrase, f
  FROM (SELECT lang, words, a AS f, size, unnest(range(1, k - size + 2)) AS i FROM c, range(2, 5) AS s(size) WHERE size < k)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
  WHERE NOT EXISTS (FROM inner_parts AS i WHERE i.lang = best.lang AND i.phrase = best.phrase AND 100 * i.f >= 100 * best.a)
) WHERE rank <= 2000
"""


def _sketch(text: str) -> str:
    """All hashes of a text's shingles, ascending, as a list."""
    words = f"list_filter(string_split_regex(lower({text}), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
    spans = "CASE WHEN len(w) = 0 THEN [] WHEN len(w) <= 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END"
    return f"(SELECT list_sort(list_distinct(list_transform({spans}, lambda s: md5(s)[:16]))) FROM (SELECT {words} AS w))"


def _covered(a: str) -> str:
    return f"CASE WHEN len({a}) < 32 THEN 'g' ELSE greatest('20000000', {a}[-1]) END"


def _containment(a: str, b: str) -> str:
    upto = f"least({_covered(a)}, {_covered(b)})"
    x, y = (f"list_filter({s}, lambda h: h <= {upto})" for s in (a, b))
    return f"CASE WHEN {a} = {b} THEN 1.0 WHEN least(len({x}), len({y})) = 0 THEN 0.0 ELSE len(list_intersect({x}, {y}))::DOUBLE / least(len({x}), len({y})) END::DOUBLE"


def _trimmed(hashes: str) -> str:
    return f"list_concat({hashes}[:32], list_filter({hashes}[33:], lambda h: h < '20000000'))"


#: The least 32 hashes and all below an eighth; rows of one id by text.
SCALED_SKETCH = f"""
WITH o AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id NULLS FIRST, coalesce(text, '')) AS i FROM documents
), e AS (
  SELECT o.doc_id, o.i, length(o.text) AS n_chars, o.text, n.i AS j,
    o.text[:length(o.text) - length(o.text) // 2] || n.text[:length(o.text) // 2] AS edited
  FROM o JOIN o AS n ON n.i = CASE WHEN o.i = (SELECT max(i) FROM o) THEN 1 ELSE o.i + 1 END
), h AS (SELECT doc_id, i, j, n_chars, edited, {_sketch("text")} AS own_all, {_sketch("edited")} AS edited_all FROM e
), s AS (SELECT *, {_trimmed("own_all")} AS own, {_trimmed("edited_all")} AS changed FROM h)
SELECT s.doc_id, s.n_chars, sha256(s.edited) AS edited_sha256, array_to_string(s.own, '') AS fingerprint,
  array_to_string(s.changed, '') AS edited_fingerprint, {_containment("s.own", "s.changed")} AS near_edited,
  {_containment("s.own", "t.own")} AS near_next
FROM s JOIN s AS t ON t.i = s.j
"""
