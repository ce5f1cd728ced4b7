"""DuckDB statements of the mining-benchmark queries (the correctness oracle).

Written independently of the Spark plans: all-pairs joins, window ranks and a
theta-join sweep (every candidate against every grid value), i.e. the brute-force
statement of each operator.  Tables ``embeddings`` etc. are views the checker provides.
"""

# Derived bilingual fixture; see lexalign/sources/fixtures.py for the rule.
FIXTURE = """
n AS (SELECT count(*) AS n FROM embeddings),
tagged AS (
  SELECT vec_id, embedding,
         (['chv-ru', 'dsb-de', 'hsb-de', 'oci-es'])[(label % 4) + 1] AS lang_pair,
         CASE WHEN (vec_id // 10) % 2 = 0 THEN 'train' ELSE 'test' END AS split
  FROM embeddings),
models(model, alpha) AS (VALUES ('m05', 0.5::DOUBLE), ('m10', 1.0::DOUBLE), ('m15', 1.5::DOUBLE)),
src AS (
  SELECT t.lang_pair, m.model, t.split, t.vec_id AS sent_id, t.embedding::DOUBLE[] AS vec
  FROM tagged t CROSS JOIN models m WHERE t.vec_id % 5 <> 0),
tgt AS (
  SELECT t.lang_pair, m.model, t.split, t.vec_id AS sent_id,
         list_transform(t.embedding, lambda x, i: x::DOUBLE + m.alpha * (o.embedding[i])::DOUBLE) AS vec
  FROM tagged t
  JOIN embeddings o ON o.vec_id = (t.vec_id + 137) % (SELECT n FROM n)
  CROSS JOIN models m
  WHERE t.vec_id % 5 <> 1),
gold AS (
  SELECT lang_pair, split, vec_id * 2 AS line_no, vec_id AS src_id, (vec_id + 137) % (SELECT n FROM n) AS tgt_id
  FROM tagged WHERE vec_id % 5 NOT IN (0, 1)
  UNION ALL
  SELECT lang_pair, split, vec_id * 2 + 1 AS line_no, vec_id AS src_id, vec_id AS tgt_id
  FROM tagged WHERE vec_id % 5 NOT IN (0, 1)),
goldc AS (SELECT lang_pair, split, src_id, arg_max(tgt_id, line_no) AS gold_tgt FROM gold GROUP BY ALL),
gold_n AS (SELECT lang_pair, split, count(*) AS gold_n FROM goldc GROUP BY ALL)
"""

PAIRS_COS = """
pairs AS (
  SELECT s.lang_pair, s.model, s.split, s.sent_id AS src_id, t.sent_id AS tgt_id,
         list_dot_product(s.vec, t.vec) / (sqrt(list_dot_product(s.vec, s.vec)) * sqrt(list_dot_product(t.vec, t.vec))) AS cos
  FROM src s JOIN tgt t USING (lang_pair, model, split)),
r_src AS (
  SELECT lang_pair, model, split, src_id, avg(cos) AS r FROM (
    SELECT *, row_number() OVER (PARTITION BY lang_pair, model, split, src_id ORDER BY cos DESC) AS rn FROM pairs)
  WHERE rn <= 20 GROUP BY ALL),
r_tgt AS (
  SELECT lang_pair, model, split, tgt_id, avg(cos) AS r FROM (
    SELECT *, row_number() OVER (PARTITION BY lang_pair, model, split, tgt_id ORDER BY cos DESC) AS rn FROM pairs)
  WHERE rn <= 20 GROUP BY ALL)
"""

CSLS = """
scored AS (
  SELECT p.*, 2 * p.cos - rs.r - rt.r AS score
  FROM pairs p JOIN r_src rs USING (lang_pair, model, split, src_id)
               JOIN r_tgt rt USING (lang_pair, model, split, tgt_id)),
cands AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY lang_pair, model, split, src_id ORDER BY score DESC, tgt_id) AS rank
    FROM scored) WHERE rank <= 10)
"""

GRID = """
grid(idx, raw) AS (
  SELECT 0, 0.1::DOUBLE
  UNION ALL
  SELECT idx + 1, raw + 0.1::DOUBLE FROM grid WHERE raw + 0.1::DOUBLE <= 5.0::DOUBLE + 1e-9::DOUBLE),
gridr AS (SELECT idx, raw, round(raw, 10) AS threshold FROM grid)
"""

SWEEP = """
stats AS (SELECT lang_pair, model, split, avg(score) AS mu, stddev_pop(score) AS sd FROM cands GROUP BY ALL),
hits AS (
  SELECT c.lang_pair, c.model, c.split, c.src_id, c.tgt_id, c.score, s.mu, s.sd,
         CASE WHEN g.gold_tgt IS NOT NULL AND c.tgt_id = g.gold_tgt THEN 1 ELSE 0 END AS hit
  FROM cands c JOIN stats s USING (lang_pair, model, split)
  LEFT JOIN goldc g USING (lang_pair, split, src_id)),
grp AS (SELECT DISTINCT lang_pair, model, split FROM cands),
cnt AS (
  SELECT g.lang_pair, g.model, g.split, gr.idx, gr.threshold,
         count(h.src_id) AS predicted, coalesce(sum(h.hit), 0)::BIGINT AS tp
  FROM grp g CROSS JOIN gridr gr
  LEFT JOIN hits h ON h.lang_pair = g.lang_pair AND h.model = g.model AND h.split = g.split
                  AND h.score > h.{cut} AND NOT isnan(h.score)
  GROUP BY ALL),
sw AS (
  SELECT c.*, coalesce(n.gold_n, 0) AS gold_n,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN coalesce(n.gold_n, 0) > 0 THEN tp / n.gold_n ELSE 0.0 END AS recall
  FROM cnt c LEFT JOIN gold_n n USING (lang_pair, split)),
sweep AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM sw),
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY lang_pair, model, split ORDER BY f1 DESC, idx) AS rn FROM sweep)
  WHERE rn = 1)
"""

DYN_CUT = "mu + gr.raw * h.sd"


def _with(*parts, recursive=False):
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(p.strip() for p in parts)


def _sweep(cut=DYN_CUT):
    return SWEEP.replace("h.{cut}", "h." + cut if not cut.startswith("gr.") else cut)


BASE = _with(FIXTURE, PAIRS_COS, CSLS)
SWEEP_BASE = _with(FIXTURE, PAIRS_COS, CSLS, GRID, _sweep(), recursive=True)

SUMMARY = """
tr AS (SELECT lang_pair, model, threshold AS train_best_th, f1 AS train_best_f1, precision AS train_best_p,
              recall AS train_best_r, idx AS train_idx FROM best WHERE split = 'train'),
te AS (SELECT lang_pair, model, threshold AS test_best_th, f1 AS test_best_f1, precision AS test_best_p,
              recall AS test_best_r FROM best WHERE split = 'test'),
near AS (
  SELECT * FROM (
    SELECT s.lang_pair, s.model, s.f1 AS test_f1_at_train_th, s.precision AS test_p_at_train_th,
           s.recall AS test_r_at_train_th,
           row_number() OVER (PARTITION BY s.lang_pair, s.model ORDER BY abs(s.threshold - tr.train_best_th), s.idx) AS rn
    FROM sweep s JOIN tr USING (lang_pair, model) WHERE s.split = 'test') WHERE rn = 1),
summary AS (
  SELECT tr.lang_pair, tr.model, train_best_th, train_best_f1, train_best_p, train_best_r,
         test_best_th, test_best_f1, test_best_p, test_best_r,
         test_f1_at_train_th, test_p_at_train_th, test_r_at_train_th,
         test_best_f1 - test_f1_at_train_th AS transfer_gap,
         (train_idx = 0 OR train_idx = (SELECT max(idx) FROM gridr)) AS at_grid_edge
  FROM tr LEFT JOIN te USING (lang_pair, model) LEFT JOIN near USING (lang_pair, model))
"""

ORACLE = {
    "cosine_topk": _with(FIXTURE, PAIRS_COS) + """
SELECT lang_pair, model, split, src_id, tgt_id, rank, round(cos, 6) AS cos FROM (
  SELECT *, row_number() OVER (PARTITION BY lang_pair, model, split, src_id ORDER BY cos DESC, tgt_id) AS rank
  FROM pairs) WHERE rank <= 10""",
    "csls_means": _with(FIXTURE, PAIRS_COS) + """
SELECT lang_pair, model, split, 'src' AS side, src_id AS sent_id, round(r, 6) AS r FROM r_src
UNION ALL
SELECT lang_pair, model, split, 'tgt' AS side, tgt_id AS sent_id, round(r, 6) AS r FROM r_tgt""",
    "csls_mine": BASE + """
SELECT lang_pair, model, split, src_id, tgt_id, rank, round(cos, 6) AS cos, round(score, 6) AS score FROM cands""",
    "filter_static": BASE + """
SELECT lang_pair, model, split, src_id, tgt_id, round(score, 6) AS score FROM cands
WHERE score > 0.5 AND NOT isnan(score)""",
    "filter_dynamic": BASE + """,
stats AS (SELECT lang_pair, model, split, avg(score) AS mu, stddev_pop(score) AS sd FROM cands GROUP BY ALL)
SELECT c.lang_pair, c.model, c.split, c.src_id, c.tgt_id, round(c.score, 6) AS score
FROM cands c JOIN stats s USING (lang_pair, model, split)
WHERE c.score > s.mu + 1.0 * s.sd AND NOT isnan(c.score)""",
    "gold_last_wins": _with(FIXTURE) + """
SELECT lang_pair, split, src_id, gold_tgt AS tgt_id FROM goldc""",
    "evaluate_prf": BASE + """,
stats AS (SELECT lang_pair, model, split, avg(score) AS mu, stddev_pop(score) AS sd FROM cands GROUP BY ALL),
preds AS (SELECT c.* FROM cands c JOIN stats s USING (lang_pair, model, split)
          WHERE c.score > s.mu + 1.0 * s.sd AND NOT isnan(c.score)),
cnt AS (
  SELECT g.lang_pair, g.model, g.split, count(p.src_id) AS predicted,
         coalesce(sum(CASE WHEN p.tgt_id = gc.gold_tgt THEN 1 ELSE 0 END), 0)::BIGINT AS tp
  FROM (SELECT DISTINCT lang_pair, model, split FROM cands) g
  LEFT JOIN preds p USING (lang_pair, model, split)
  LEFT JOIN goldc gc ON gc.lang_pair = p.lang_pair AND gc.split = p.split AND gc.src_id = p.src_id
  GROUP BY ALL),
m AS (
  SELECT c.*, coalesce(n.gold_n, 0) AS gold_n,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN coalesce(n.gold_n, 0) > 0 THEN tp / n.gold_n ELSE 0.0 END AS recall
  FROM cnt c LEFT JOIN gold_n n USING (lang_pair, split))
SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
FROM m""",
    "threshold_sweep": SWEEP_BASE + """
SELECT lang_pair, model, split, idx, threshold, predicted, tp, gold_n, precision, recall, f1 FROM sweep""",
    "threshold_sweep_static": _with(FIXTURE, PAIRS_COS, CSLS, GRID, _sweep("gr.raw"), recursive=True) + """
SELECT lang_pair, model, split, idx, threshold, predicted, tp, gold_n, precision, recall, f1 FROM sweep""",
    "best_threshold": SWEEP_BASE + """
SELECT lang_pair, model, split, idx, threshold, precision, recall, f1 FROM best""",
    "best_predictions": SWEEP_BASE + """
SELECT c.lang_pair, c.model, c.split, c.src_id, c.tgt_id
FROM cands c JOIN stats s USING (lang_pair, model, split) JOIN best b USING (lang_pair, model, split)
WHERE c.score > s.mu + b.threshold * s.sd AND NOT isnan(c.score)""",
    "transfer_predictions": SWEEP_BASE + """
SELECT c.lang_pair, c.model, c.split, c.src_id, c.tgt_id
FROM cands c JOIN stats s USING (lang_pair, model, split)
JOIN (SELECT lang_pair, model, threshold FROM best WHERE split = 'train') b USING (lang_pair, model)
WHERE c.split = 'test' AND c.score > s.mu + b.threshold * s.sd AND NOT isnan(c.score)""",
    "transfer_summary": SWEEP_BASE + ",\n" + SUMMARY.strip() + """
SELECT * FROM summary""",
    "leaderboard": SWEEP_BASE + ",\n" + SUMMARY.strip() + """
SELECT row_number() OVER (ORDER BY coalesce(test_best_f1, 0.0) DESC,
                          list_position(['m05', 'm10', 'm15'], model),
                          list_position(['chv-ru', 'dsb-de', 'hsb-de', 'oci-es'], lang_pair)) AS rank,
       lang_pair, model, train_best_th, test_best_f1, test_f1_at_train_th, transfer_gap
FROM summary""",
}
