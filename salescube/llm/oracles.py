"""Reference SQL (DuckDB) of the queries that SQL can express over whole tables.

Scoring by a language model, compression, profiles, merges, entropy and bootstrapping are not expressed here: their tests compare
with plain versions in Python, a library's result, an exact round trip, or held-out accuracy.
"""

_INK = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


_NEAR = f"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_INK}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
either AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reached r JOIN either e ON r.other = e.a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

_SUBSTRINGS = f"""WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_INK}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words)),
again AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM windows JOIN again USING (k), unnest(range(35)) AS t(j)),
listed AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words),
kept AS (
  SELECT l.doc_id, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY l.i) FILTER (g.i IS NULL) AS kept
  FROM listed l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""

_QUALITY = f"""WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_INK}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)),
again AS (SELECT doc_id, k FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM windows JOIN again USING (doc_id, k), unnest(range(5)) AS t(j) GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_INK}')) AS l FROM words),
measures AS (
  SELECT doc_id, text, CAST(len(w) AS bigint) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS bigint) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS bigint) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS bigint) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measures)
SELECT * EXCLUDE (text), NOT (
  base_failed OR 2 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
  OR 2 * len(regexp_extract_all(text, '[A-Z]')) > word_chars OR 2 * n_dup_lines > len(string_split(text, chr(10)))) AS kept
FROM judged"""

_SPACED = "regexp_extract_all(" + _lower("coalesce(text, '')") + r", '[a-z0-9\x{80}-\x{10FFFF}]+')"
_FIVES = """CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"""

_LEAKS = f"""WITH items AS (
  SELECT DISTINCT item_id, unnest({_FIVES}) AS s FROM (SELECT item_id, {_SPACED} AS w FROM benchmark)),
sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
lengths AS (SELECT DISTINCT len(string_split(s, ' ')) AS n FROM items),
docs AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
         FROM (SELECT doc_id, {_SPACED} AS w FROM documents), lengths),
shared AS (SELECT doc_id, item_id, count(*) AS common FROM docs JOIN items USING (s) GROUP BY ALL),
found AS (
  SELECT doc_id, item_id, CAST(common AS double) / n AS containment FROM shared JOIN sizes USING (item_id) WHERE 10 * common >= 8 * n
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(common AS double) / n DESC, item_id) = 1)
SELECT doc_id, item_id, containment, item_id IS NOT NULL AS contaminated FROM documents LEFT JOIN found USING (doc_id)"""

_LINES = f"""WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM split),
keyed AS (SELECT doc_id, i, line, {_lower("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines),
repeated AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_TRIE = f"""WITH RECURSIVE steps(b, n, c) AS (
  SELECT b, 0, b FROM range(256) AS t(b) UNION ALL SELECT b, n + 1, {_CRC_STEP} FROM steps WHERE n < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE n = 8),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS varchar), ''), lambda x: CAST(ascii(x) AS bigint))),
                         lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc_table),
parts AS (
  SELECT c.conv_id, 0 AS part, o.n, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.n <= c.h
  UNION ALL SELECT c.conv_id, 1, o.n, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.n > c.h),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, n) AS d, strlen(text) AS size,
         sha256(strlen(role) || ':' || role || text) AS t FROM parts),
whole AS (SELECT c.conv_id, coalesce(list(t ORDER BY d) FILTER (t IS NOT NULL), []) AS s FROM convs c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id),
members AS (
  SELECT conv_id, CAST(d AS bigint) AS depth, list_slice(s, 1, d) AS k, len(s) = d AS ends
  FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM whole)),
nodes AS (
  SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY k, depth),
weighed AS (
  SELECT n.*, (n_convs - 1) * coalesce(size, 0) AS saved, list_slice(k, 1, depth - 1) AS up
  FROM nodes n LEFT JOIN turns t ON t.conv_id = n.conv_id AND t.d = n.depth),
children AS (SELECT up AS k, count(*) AS n FROM weighed WHERE depth > 0 GROUP BY up),
counted AS (SELECT w.*, coalesce(c.n, 0) AS n_children FROM weighed w LEFT JOIN children c USING (k)),
above AS (
  SELECT list_slice(k, 1, d) AS k, saved, n_children = 0 AS leaf FROM (SELECT k, saved, n_children, unnest(range(depth + 1)) AS d FROM counted)),
subtrees AS (SELECT k, CAST(sum(saved) AS bigint) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM above GROUP BY k)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM counted n JOIN subtrees s USING (k) LEFT JOIN nodes p ON n.depth > 0 AND p.k = n.up"""

_HARD = """WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS double))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS mine, b.vec_id AS other, b.label AS label, CAST(list_inner_product(a.v, b.v) AS bigint) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, mine, other AS positive_id, score AS positive_score FROM scored WHERE label = mine
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS integer) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE label <> positives.mine AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""

ORACLES: dict[str, str] = {
    "op4_near_dedup": _NEAR,
    "op6_substring_dedup": _SUBSTRINGS,
    "op8_quality_rules": _QUALITY,
    "op9_decontamination": _LEAKS,
    "op11_line_dedup": _LINES,
    "op12_prefix_trie": _TRIE,
    "op13_hard_negatives": _HARD,
}
