"""SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

# written out again, so that the SQL does not follow the code that it checks
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW, MIN_GROUP = 20, 30, 8, 100
_RULES = {  # figure: percentile, spreads
    "symbols_permille": (90, 4), "duplicates_permille": (99, 1), "repeats_permille": (99, 1), "chars_percent": (90, 4),
}
_WORD = r"[^\x20\x09-\x0D]+"
_FIGURES = {
    "symbols_permille": "n_symbols * 1000 // n_words",
    "duplicates_permille": "n_dup_lines * 1000 // n_words",
    "repeats_permille": "n_repeat_words * 1000 // n_words",
    "chars_percent": "word_chars * 100 // n_words",
}


def _quality() -> str:
    levels = {"own": "lang, source", "language": "lang", "every": None}
    quantiles = "".join(
        f"""
{name}_steps AS (
  SELECT {keys + ', ' if keys else ''}figure, bucket, count(*) AS n FROM buckets GROUP BY ALL),
{name}_seen AS (
  SELECT *, sum(n) OVER g AS total, sum(n) OVER (g ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS seen
  FROM {name}_steps WINDOW g AS (PARTITION BY {keys + ', ' if keys else ''}figure)),
{name}_at AS (
  SELECT {keys + ', ' if keys else ''}figure, any_value(total) AS total,
    min(bucket) FILTER (WHERE seen * 100 >= total * 50) AS b50, min(bucket) FILTER (WHERE seen * 100 >= total * 90) AS b90,
    min(bucket) FILTER (WHERE seen * 100 >= total * 99) AS b99
  FROM {name}_seen GROUP BY ALL),"""
        for name, keys in levels.items()
    )
    figures = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS figure, CAST({value} AS BIGINT) AS v FROM base WHERE NOT base_failed"
        for name, value in _FIGURES.items()
    )
    rules = ", ".join(f"('{name}', {percent}, {spreads})" for name, (percent, spreads) in _RULES.items())
    inside = " AND ".join(
        f"coalesce(({value}) <= (SELECT most FROM limits l WHERE l.figure = '{name}' AND l.lang IS NOT DISTINCT FROM "
        "base.lang AND l.source IS NOT DISTINCT FROM base.source), true)"
        for name, value in _FIGURES.items()
    )
    edge = lambda b: f"(({b} % 128 + 1) << CAST({b} // 128 AS INTEGER)) - 1"
    return f"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words WHERE len(w) >= {WINDOW})),
again AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
  SELECT doc_id, sum(least({WINDOW}, n - i)) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i, 1, i + {WINDOW}) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM again) GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM words),
base AS (
  SELECT w.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    len(w) < {MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MAX_REPEAT_PERCENT} * len(w) AS base_failed
  FROM words w JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
figures AS ({figures}),
buckets AS (
  SELECT lang, source, figure, greatest(length(bin(v)) - 7, 0) * 128 + (v >> CAST(greatest(length(bin(v)) - 7, 0) AS INTEGER)) AS bucket
  FROM figures),{quantiles}
rules(figure, percent, spreads) AS (VALUES {rules}),
chosen AS (
  SELECT g.lang, g.source, r.*,
    CASE WHEN o.total >= {MIN_GROUP} THEN o.b50 WHEN a.total >= {MIN_GROUP} THEN a.b50 ELSE e.b50 END AS b50,
    CASE WHEN percent = 90 THEN
      CASE WHEN o.total >= {MIN_GROUP} THEN o.b90 WHEN a.total >= {MIN_GROUP} THEN a.b90 ELSE e.b90 END
    ELSE CASE WHEN o.total >= {MIN_GROUP} THEN o.b99 WHEN a.total >= {MIN_GROUP} THEN a.b99 ELSE e.b99 END END AS high
  FROM (SELECT DISTINCT lang, source FROM documents) g CROSS JOIN rules r
  LEFT JOIN own_at o ON o.figure = r.figure AND o.lang IS NOT DISTINCT FROM g.lang AND o.source IS NOT DISTINCT FROM g.source
  LEFT JOIN language_at a ON a.figure = r.figure AND a.lang IS NOT DISTINCT FROM g.lang
  LEFT JOIN every_at e ON e.figure = r.figure),
limits AS (
  SELECT lang, source, figure, {edge('high')} + spreads * ({edge('high')} - ({edge('b50')})) + 1 AS most FROM chosen)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CASE WHEN base_failed THEN false ELSE {inside} END AS kept
FROM base
"""


_ARCHIVE = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

_LINES = """
WITH l AS (
  SELECT doc_id, n, string_split(coalesce(text, ''), chr(10)) AS lines FROM (SELECT doc_id, text, row_number() OVER () AS n FROM documents)),
e AS (SELECT doc_id, n, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM l),
k AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM e),
c AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, last IS NOT NULL AND last IS DISTINCT FROM doc_id AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY n, doc_id
"""

def _merkle_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value} END"


def _merkle_leaf(text: str) -> str:
    fields = [_merkle_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


#: The CRC-32 of a decimal number, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)),
    4294967295::BIGINT)"""

_MERKLE = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, source, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS row_no, {_merkle_leaf('text')} AS leaf,
    CASE WHEN {_CRC} % 5 = 0 THEN {_merkle_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents),
p AS (SELECT *, coalesce('=' || source, '') AS grp, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
tree(grp, height, pos, digest) AS (
  SELECT grp, 0, pos, leaf FROM p
  UNION ALL
  SELECT grp, height + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM tree) WHERE n > 1 GROUP BY grp, height, pos // 16),
tops AS (SELECT grp, max(height) AS top FROM tree GROUP BY grp),
subroots AS (
  SELECT grp, digest, row_number() OVER (ORDER BY encode(grp)) - 1 AS place FROM tree JOIN tops USING (grp) WHERE height = top),
over(height, pos, digest) AS (
  SELECT 0, place, digest FROM subroots
  UNION ALL
  SELECT height + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM over) WHERE n > 1 GROUP BY height, pos // 16),
root AS (SELECT max(height) AS top, arg_max(digest, height) AS root FROM over),
-- one row per leaf and level: the places of the node above the leaf, and its siblings before and after
steps AS (
  SELECT row_no, t.height AS step, t.pos AS own, s.pos AS other, s.digest FROM p
  JOIN tops o ON o.grp = p.grp
  JOIN tree t ON t.grp = p.grp AND t.height < o.top AND t.pos = p.pos // CAST(pow(16, t.height) AS BIGINT)
  JOIN tree s ON s.grp = t.grp AND s.height = t.height AND s.pos // 16 = t.pos // 16
  UNION ALL
  SELECT row_no, o.top + t.height, t.pos, s.pos, s.digest FROM p
  JOIN tops o ON o.grp = p.grp JOIN subroots b ON b.grp = p.grp CROSS JOIN root
  JOIN over t ON t.height < root.top AND t.pos = b.place // CAST(pow(16, t.height) AS BIGINT)
  JOIN over s ON s.height = t.height AND s.pos // 16 = t.pos // 16),
levels AS (
  SELECT row_no, step, coalesce(string_agg(digest, '' ORDER BY other) FILTER (WHERE other < own), '') AS before,
    coalesce(string_agg(digest, '' ORDER BY other) FILTER (WHERE other > own), '') AS after
  FROM steps GROUP BY row_no, step, own),
path AS (
  SELECT row_no, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256,
    list({{'b': before, 'a': after}} ORDER BY step) AS path
  FROM levels GROUP BY row_no)
SELECT doc_id, leaf, b.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM (
  SELECT p.*, proof_sha256, list_reduce(list_prepend({{'b': coalesce(changed, leaf), 'a': ''}}, coalesce(path, [])),
    lambda node, s: {{'b': sha256(s.b || node.b || s.a), 'a': ''}}).b AS folded
  FROM p LEFT JOIN path USING (row_no)) q
JOIN subroots b ON b.grp = q.grp CROSS JOIN root
"""

ORACLES = {"op1_quality_rules": _quality(), "op2_arc_to_warc": _ARCHIVE, "op11_line_dedup": _LINES, "op13_merkle": _MERKLE}
