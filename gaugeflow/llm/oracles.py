"""DuckDB counterparts of the queries that SQL can express."""

from gaugeflow.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{form}'" for w in STOP_WORDS for form in dict.fromkeys((w, w.capitalize())))
_WORD = r"[^\x20\x09-\x0D]+"

OP8 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '{_WORD}') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM d
), g AS (
  SELECT rid, i, array_to_string(list_slice(words, i, i + 7), ' ') AS gram
  FROM w, unnest(range(1, len(words) - 6)) AS u(i)
), again AS (
  SELECT rid, gram FROM g GROUP BY ALL HAVING count(*) > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT g.rid, unnest(range(g.i, g.i + 8)) AS p FROM g JOIN again USING (rid, gram))
  GROUP BY rid
), m AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words,
    len(lines) AS n_lines,
    len(list_filter(lines, lambda x: len(regexp_extract_all(x, '{_WORD}')) < 3)) AS n_short_lines,
    len(list_filter(words, lambda x: x IN ({_STOP}))) AS n_stop_words,
    len(list_filter(words, lambda x: regexp_matches(x, '\pL'))) AS n_alphabetic,
    len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_same_as_before
  FROM w LEFT JOIN covered USING (rid)
), b AS (
  SELECT CAST(COLUMNS(*) AS BIGINT),
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM m
)
SELECT *, NOT base_failed
    AND 10 * word_chars BETWEEN 25 * n_words AND 120 * n_words
    AND 10 * n_symbols <= n_words
    AND 20 * n_stop_words >= n_words
    AND 10 * n_alphabetic >= 7 * n_words
    AND 10 * n_short_lines <= 9 * n_lines
    AND 2 * n_dup_lines <= n_lines
    AND 10 * n_same_as_before <= 3 * n_words AS kept
FROM b
"""

_LAST = "9223372036854775807"

OP2 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, {_LAST}) AS owner,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents
), g AS (
  SELECT rid, owner, i, array_to_string(list_slice(w, i, i + 12), ' ') AS gram
  FROM d, unnest(range(1, len(w) - 11)) AS u(i)
), f AS (
  SELECT gram, min(owner) AS first_owner FROM g GROUP BY gram
), gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + 13)) AS p
  FROM g JOIN f USING (gram) WHERE owner > first_owner
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY p) AS words
  FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d)
  ANTI JOIN gone USING (rid, p)
  GROUP BY rid
), counted AS (
  SELECT rid, count(*) AS n FROM gone GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid) LEFT JOIN counted USING (rid)
"""

OP3 = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '{_WORD}') AS w
  FROM documents
), s AS (
  SELECT DISTINCT rid, array_to_string(list_slice(w, i, i + 4), ' ') AS gram
  FROM d, unnest(range(1, greatest(len(w) - 3, least(len(w) + 1, 2)))) AS u(i)
), n AS (
  SELECT rid, count(*) AS n FROM s GROUP BY rid
), pairs AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS shared
  FROM s AS a JOIN s AS b USING (gram) WHERE a.rid <> b.rid GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN n AS p ON p.rid = x JOIN n AS q ON q.rid = y
  WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), reach AS (
  SELECT rid, rid AS root FROM d
  UNION
  SELECT y, root FROM reach JOIN links ON x = rid
), c AS (
  SELECT reach.root AS rid, min(d.doc_id) AS component_id
  FROM reach JOIN d USING (rid) GROUP BY ALL
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id,
  coalesce(doc_id = component_id, component_id IS NULL) AS kept
FROM d JOIN c USING (rid) LEFT JOIN n USING (rid)
"""

OP4 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(text), '[\pL\pN]+') AS w
  FROM documents WHERE text IS NOT NULL
), items AS (
  SELECT w, len(w) AS size, min(item_id) AS item_id
  FROM (SELECT item_id, regexp_extract_all(lower(text), '[\pL\pN]+') AS w FROM benchmark WHERE text IS NOT NULL)
  WHERE len(w) > 0 GROUP BY w
), dg AS (
  SELECT rid, i, array_to_string(list_slice(w, i, i + 4), ' ') AS gram
  FROM d, unnest(range(1, greatest(len(w) - 3, least(len(w) + 1, 2)))) AS u(i)
), ig AS (
  SELECT item_id, size, gram, count(*) AS n
  FROM (SELECT item_id, size, array_to_string(list_slice(w, i, i + 4), ' ') AS gram
        FROM items, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i) WHERE size >= 5)
  GROUP BY ALL
), total AS (
  SELECT item_id, size, sum(n) AS n FROM ig GROUP BY ALL
), starts AS (
  SELECT DISTINCT rid, item_id, size,
    greatest(least(i - 1, len(w) - size), 0) AS s, greatest(least(size, len(w)) - 4, 1) AS grams
  FROM dg JOIN (SELECT DISTINCT gram, size FROM ig) USING (gram) JOIN d USING (rid)
    JOIN total USING (size)
), shared AS (
  SELECT rid, item_id, size, s, grams, sum(least(k, ig.n)) AS shared
  FROM (SELECT rid, item_id, size, s, grams, gram, count(*) AS k
        FROM starts JOIN dg USING (rid) WHERE i BETWEEN s + 1 AND s + grams GROUP BY ALL)
    JOIN ig USING (item_id, size, gram)
  GROUP BY ALL
), scored AS (
  SELECT rid, item_id, size, s, CAST(shared AS DOUBLE) / CAST(grams + total.n - shared AS DOUBLE) AS similarity
  FROM shared JOIN total USING (item_id, size)
  UNION ALL
  SELECT rid, item_id, size, s, 1.0 AS similarity
  FROM (SELECT rid, i - 1 AS s, list_slice(w, i, i + n - 1) AS part
        FROM d, unnest(range(1, 5)) AS v(n), unnest(range(1, len(w) - n + 2)) AS u(i))
    JOIN items ON items.w = part
)
SELECT doc_id, item_id, max(similarity) AS similarity,
  CAST(arg_min(s, (-similarity, s)) AS BIGINT) AS start, CAST(size AS BIGINT) AS n_words
FROM scored JOIN d USING (rid) WHERE similarity >= 0.8 GROUP BY rid, doc_id, item_id, size
"""

OP6 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY ALL
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM coalesce(first_id, page_id) THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN page_id IS DISTINCT FROM coalesce(first_id, page_id) THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP11 = """
WITH t AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')}
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), ops AS (
  SELECT conv_id, turns, list_prepend(4294967295, flatten(list_transform(
      string_split(CAST(conv_id AS VARCHAR), ''),
      lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))) AS steps
  FROM t
), h AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(steps, lambda crc, step: CASE
      WHEN step >= 0 THEN xor(crc, step)
      ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END)) % 6 AS h
  FROM ops
), b AS (
  SELECT h.conv_id, list_concat(
      coalesce(list_slice(base.turns, 1, h.h), []), coalesce(list_slice(h.turns, h.h + 1, len(h.turns)), [])) AS seq
  FROM h LEFT JOIN h AS base ON base.conv_id = h.conv_id - h.conv_id % 100
), p AS (
  SELECT conv_id, d, list_slice(seq, 1, d) AS node, len(seq) = d AS ends
  FROM b, unnest(range(0, len(seq) + 1)) AS u(d)
), n AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE length(node[d].x) END AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY node, d
), c AS (
  SELECT list_slice(node, 1, d - 1) AS node, d - 1 AS d, count(*) AS n_children
  FROM n WHERE d > 0 GROUP BY ALL
), m AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (node, d)
), s AS (
  SELECT list_slice(node, 1, u.a) AS node, u.a AS d,
    CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
    CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM m, unnest(range(0, d + 1)) AS u(a) GROUP BY ALL
)
SELECT m.conv_id, m.d AS depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves,
  s.saved_tokens, m.ends_sha256
FROM m JOIN s USING (node, d) LEFT JOIN m AS up ON m.d > 0 AND up.d = m.d - 1 AND up.node = list_slice(m.node, 1, m.d - 1)
"""

ORACLES = {
    "op11_prefix_trie": OP11,
    "op2_substring_dedup": OP2,
    "op3_minhash_near_dedup": OP3,
    "op4_benchmark_decontamination": OP4,
    "op6_warc": OP6,
    "op8_quality_rules": OP8,
}
