"""DuckDB statements of the line-level reader and writer queries."""

from oracle.mining_sql import FIXTURE
from oracle.mining_sql import ORACLE as MINING

ORACLE = {
    "parse_sentences": """
WITH l AS (SELECT doc_id, lang, string_split(CASE doc_id % 10 WHEN 3 THEN doc_id::VARCHAR
    WHEN 7 THEN doc_id::VARCHAR || chr(9) || 'word' || chr(9) || 'extra'
    ELSE doc_id::VARCHAR || chr(9) || translate(text, chr(9) || chr(10), '  ') END, chr(9)) AS p FROM documents)
SELECT 'oci-es' AS lang_pair, 'train' AS split, lang, doc_id AS line_no, p[1] AS sent_id, p[2] AS text, len(p) <> 2 AS bad FROM l""",
    "parse_gold": """
SELECT 'hsb-de' AS lang_pair, 'test' AS split, '/c/hsb-de.test.gold' AS file, vec_id AS line_no, vec_id::VARCHAR AS src_id,
       CASE WHEN vec_id % 10 <> 4 THEN (vec_id + 1)::VARCHAR END AS tgt_id, vec_id % 10 = 4 AS bad FROM embeddings""",
    "parse_candidates": """
SELECT 'hsb-de' AS lang_pair, 'test' AS split, 'm05' AS model, vec_id AS line_no, vec_id::VARCHAR AS src_id, vec_id::VARCHAR AS tgt_id,
       vec_id % 11 = 5 OR vec_id % 7 IN (3, 6) AS bad,
       CASE WHEN vec_id % 11 = 5 OR vec_id % 7 IN (3, 6) THEN 'none' WHEN vec_id % 7 = 2 THEN 'nan' WHEN vec_id % 7 = 5 THEN 'inf'
            ELSE 'number' END AS kind,
       CASE WHEN vec_id % 11 = 5 THEN NULL ELSE (CASE vec_id % 7 WHEN 0 THEN 0.5 WHEN 1 THEN 0.001 WHEN 4 THEN 10.25 END)::DOUBLE END AS score
FROM embeddings""",
    "parse_vec": """
SELECT 'hsb-de' AS lang_pair, 'test' AS split, 'hsb' AS lang, 'm05' AS model, vec_id AS line_no, vec_id::VARCHAR AS sent_id,
       0.5::DOUBLE AS v0, (vec_id * 0.25)::FLOAT::DOUBLE AS v1, (-1.25)::DOUBLE AS v2
FROM embeddings WHERE vec_id > 0 AND vec_id % 9 <> 2""",
    "vec_lines": f"""
WITH {FIXTURE.strip()}
SELECT lang_pair, model, split, sent_id AS line,
       sent_id::VARCHAR || ' ' || array_to_string(list_transform(vec, lambda x: printf('%.6f', x)), ' ') AS value FROM src
UNION ALL
SELECT lang_pair, model, split, -1 AS line, count(*)::VARCHAR || ' ' || max(len(vec))::VARCHAR AS value FROM src GROUP BY ALL""",
    "prediction_lines": f"""
WITH {FIXTURE.strip()}
SELECT lang_pair, model, split, sent_id::VARCHAR || chr(9) || (sent_id + 1)::VARCHAR AS value FROM src""",
    "unit_predictions": f"""
WITH {FIXTURE.strip()}
SELECT lang_pair, model, split, sent_id AS src_id, sent_id + CASE model WHEN 'm10' THEN 2 ELSE 1 END AS tgt_id FROM src""",
    "unit_commits": f"""
WITH {FIXTURE.strip()},
even AS (SELECT lang_pair, model, split, count(*) AS n FROM src WHERE lang_pair = 'hsb-de' AND sent_id % 2 = 0 GROUP BY ALL)
SELECT lang_pair, model, split, coalesce(any_value(n), count(*))::BIGINT AS n_rows,
       (CASE WHEN any_value(n) IS NULL THEN 1 ELSE 2 END)::BIGINT AS version
FROM src LEFT JOIN even USING (lang_pair, model, split) WHERE lang_pair <> 'oci-es' GROUP BY lang_pair, model, split""",
    "pending_listing": f"""
WITH {FIXTURE.strip()}
SELECT DISTINCT lang_pair, model, split FROM src WHERE model = 'm10'""",
    "sweep_csv": f"SELECT lang_pair, model, split, threshold, precision, recall, f1 FROM ({MINING['threshold_sweep']})",
    "summary_csv": f"SELECT * EXCLUDE (at_grid_edge) FROM ({MINING['transfer_summary']})",
    "quarantine": """
WITH l AS (SELECT lang, doc_id % 10 IN (3, 7) AS bad, CASE doc_id % 10 WHEN 3 THEN NULL WHEN 7 THEN 4
    ELSE length(text) END AS n FROM documents)
SELECT CASE WHEN bad THEN 'bad' ELSE 'good' END AS kind, lang, count(*) AS n_rows, sum(n)::BIGINT AS n_chars,
       (SELECT count(*) FROM l m WHERE m.bad = l.bad) AS observed
FROM l GROUP BY bad, lang""",
    "vec_file": f"""
WITH {FIXTURE.strip()}
SELECT lang_pair, model, split, row_number() OVER (PARTITION BY lang_pair, model, split ORDER BY sent_id) AS line,
       sent_id::VARCHAR || ' ' || array_to_string(list_transform(vec, lambda x: printf('%.6f', x)), ' ') AS value FROM src
UNION ALL
SELECT lang_pair, model, split, 0 AS line, count(*)::VARCHAR || ' ' || max(len(vec))::VARCHAR AS value FROM src GROUP BY ALL""",
}
