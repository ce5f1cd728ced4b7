"""DuckDB statements of the parallel-corpus queries: global row_number windows (the
brute-force form of the distributed ordinals)."""

# Python str.strip() whitespace, spelled out for RE2 (whose \s is ASCII only).
WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

RAW = f"""
docs AS (SELECT doc_id, lang, string_split(text, chr(10)) AS ls FROM documents WHERE lang IS NOT NULL),
raw AS (
  SELECT lang, doc_id, pos, regexp_replace(line, '^{WS}+|{WS}+$', '', 'g') AS line FROM (
    SELECT lang, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM docs))
"""

INDEP = """
kept AS (
  SELECT lang, line, row_number() OVER (PARTITION BY lang ORDER BY doc_id, pos) - 1 AS ord
  FROM raw WHERE line <> ''),
zipped AS (
  SELECT o.lang || '-de' AS pair, a.ord, a.line AS english, o.line AS non_english
  FROM kept a JOIN kept o ON a.ord = o.ord WHERE a.lang = 'de' AND o.lang <> 'de')
"""

PAIRWISE = """
numbered AS (
  SELECT lang, line, row_number() OVER (PARTITION BY lang ORDER BY doc_id, pos) - 1 AS raw_ord FROM raw),
z0 AS (
  SELECT o.lang || '-de' AS pair, a.raw_ord, a.line AS english, o.line AS non_english
  FROM numbered a JOIN numbered o ON a.raw_ord = o.raw_ord
  WHERE a.lang = 'de' AND o.lang <> 'de' AND a.line <> '' AND o.line <> ''),
zipped AS (
  SELECT pair, row_number() OVER (PARTITION BY pair ORDER BY raw_ord) - 1 AS ord, english, non_english FROM z0)
"""

SPLIT = """
keyed AS (SELECT *, md5(concat_ws(':', '42', pair, ord::VARCHAR)) AS h FROM zipped),
sizes AS (SELECT pair, count(*) AS n, least(1000, floor(count(*) * 0.1::DOUBLE))::BIGINT AS eval_n FROM zipped GROUP BY ALL),
ranked AS (SELECT k.*, row_number() OVER (PARTITION BY pair ORDER BY h, ord) AS rn FROM keyed k),
split AS (
  SELECT r.pair, r.ord, CASE WHEN r.rn <= s.eval_n THEN 'eval' ELSE 'train' END AS part
  FROM ranked r JOIN sizes s USING (pair))
"""


def _with(*parts):
    return "WITH " + ",\n".join(p.strip() for p in parts)


ORACLE = {
    "parallel_lines": _with(RAW) + """
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id, pos) - 1 AS ord, line
FROM raw WHERE line <> ''""",
    "parallel_zip": _with(RAW, INDEP) + "\nSELECT pair, ord, english, non_english FROM zipped",
    "parallel_pairwise": _with(RAW, PAIRWISE) + "\nSELECT pair, ord, english, non_english FROM zipped",
    "parallel_cap": _with(RAW, INDEP) + "\nSELECT pair, ord, english, non_english FROM zipped WHERE ord < 250",
    "train_eval_split": _with(RAW, INDEP, SPLIT) + "\nSELECT pair, ord, part FROM split",
    "corpus_report": _with(RAW, INDEP, SPLIT) + """
SELECT pair, count(*) AS loaded, sum(CASE WHEN part = 'train' THEN 1 ELSE 0 END)::BIGINT AS train,
       sum(CASE WHEN part = 'eval' THEN 1 ELSE 0 END)::BIGINT AS eval
FROM split GROUP BY ALL""",
}
