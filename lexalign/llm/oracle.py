"""DuckDB statements of the queries that SQL can express."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _secrets() -> str:
    """Matches and the text between them, as lists; places are sums of their lengths."""
    from .secret_scan import BASE, RULES

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    parts = "\nUNION ALL\n".join(
        f"""SELECT n, {i} AS rank, {quoted(r.kind)} AS kind, {r.least} AS least,
       list_transform(regexp_extract_all(text, {quoted(r.pattern)}), lambda x: length(x)) AS size,
       list_transform(regexp_extract_all(text, {quoted(r.pattern)}, {r.group}), lambda x: length(x)) AS part,
       list_transform(string_split_regex(text, {quoted(r.pattern)}), lambda x: length(x)) AS gap
  FROM d WHERE regexp_matches(text, {quoted(r.pattern)})""" for i, r in enumerate(RULES))
    return f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
k AS ({parts}),
hits AS (SELECT *, unnest(range(1, len(size) + 1)) AS i FROM k),
spans AS (
  SELECT n, rank, kind, (list_sum(gap[1:i]) + coalesce(list_sum(size[1:i - 1]), 0))::BIGINT AS start, size[i] AS size
  FROM hits WHERE part[i] >= least),
words AS (SELECT n, rank, kind, start, kind || ':' || start || ':' || (start + size) AS span FROM spans),
docs AS (
  SELECT n, count(*) FILTER (WHERE rank = 0) AS a, count(*) FILTER (WHERE rank = 1) AS c, count(*) FILTER (WHERE rank = 2) AS h,
         string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM words GROUP BY n)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN docs USING (n)
"""


ORACLE = {
    "op2_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT page_id, strlen(html) AS size, h, min(page_id) OVER (PARTITION BY html) AS keeper FROM p)
SELECT page_id, size AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (CAST('0x' || substr(h, 1 + 5 * CAST(floor(i / 4) AS INT), 5) AS BIGINT) >> (5 * (3 - CAST(i % 4 AS INT)))) & 31 AS INT), 1)), '')
         AS payload_digest,
       CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper < page_id THEN keeper END AS refers_to
FROM k
""",
    "op7_line_dedup": r"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM parts),
many AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.doc_id, k.pos, k.line, m.key IS NOT NULL AND k.doc_id <> m.keeper AS gone
  FROM keyed k LEFT JOIN many m USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op8_decontamination": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(10, len(w)) AS m,
         array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM bw),
dw AS (
  SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS gram
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, dw.m AS m, item FROM dw JOIN bw USING (m, gram)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN its USING (doc_id)
""",
    "op12_secret_scan": _secrets(),
    "op13_ranked_search": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
b AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
stats AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
tf AS (
  SELECT doc_id, 50 + (50 * n * n_docs) // n_terms AS m, term, count(*) AS tf
  FROM (SELECT doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d), stats GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, stats GROUP BY term),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM b JOIN w USING (term) JOIN tf USING (term) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
""",
}
