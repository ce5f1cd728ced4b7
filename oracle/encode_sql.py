"""DuckDB statements of the encoder, vector-set and distillation queries."""

from oracle.mining_sql import FIXTURE
from oracle.parallel_sql import INDEP, RAW, SPLIT


def _with(*parts):
    return "WITH " + ",\n".join(p.strip() for p in parts)


def hashed(src: str, key: str, text: str, name: str) -> str:
    """Sparse hashed 3-gram vector (64 buckets, whole text, lower case) of ``text``."""
    return f"""
{name}_t AS (SELECT {key}, lower({text}) AS t FROM {src}),
{name}_g AS (SELECT {key}, t, unnest(range(1, length(t) - 1)) AS i FROM {name}_t WHERE length(t) >= 3),
{name}_c AS (
  SELECT {key}, (('0x' || substr(md5(substr(t, i, 3)), 1, 4))::INT % 64)::BIGINT AS dim_idx, count(*)::DOUBLE AS c
  FROM {name}_g GROUP BY ALL),
{name}_n AS (SELECT {key}, sqrt(sum(c * c)) AS nrm FROM {name}_c GROUP BY ALL),
{name} AS (SELECT {key}, dim_idx, c / nrm AS value FROM {name}_c JOIN {name}_n USING ({key}))
"""


TEACHER_STUDENT = """
n AS (SELECT count(*) AS n FROM embeddings),
models(model, alpha) AS (VALUES ('m05', 0.5::DOUBLE), ('m10', 1.0::DOUBLE), ('m15', 1.5::DOUBLE)),
ts AS (
  SELECT m.model, e.vec_id AS sent_id, e.embedding::DOUBLE[] AS teacher,
         list_transform(e.embedding, lambda x, i: x::DOUBLE + m.alpha * (o.embedding[i])::DOUBLE) AS student
  FROM embeddings e JOIN embeddings o ON o.vec_id = (e.vec_id + 137) % (SELECT n FROM n) CROSS JOIN models m),
mse AS (
  SELECT model, 100.0 * sum(list_sum(list_transform(teacher, lambda x, i: (x - student[i]) * (x - student[i]))))
                / sum(len(teacher)) AS mse
  FROM ts GROUP BY ALL),
cosines AS (
  SELECT a.model, a.sent_id AS src_id, b.sent_id AS tgt_id,
         list_dot_product(a.teacher, b.student)
           / (sqrt(list_dot_product(a.teacher, a.teacher)) * sqrt(list_dot_product(b.student, b.student))) AS cos
  FROM ts a JOIN ts b USING (model)),
fw AS (SELECT model, avg(CASE WHEN src_id = tgt_id THEN 1.0 ELSE 0.0 END) AS src2trg FROM (
  SELECT *, row_number() OVER (PARTITION BY model, src_id ORDER BY cos DESC, tgt_id) AS rn FROM cosines)
  WHERE rn = 1 GROUP BY ALL),
bw AS (SELECT model, avg(CASE WHEN src_id = tgt_id THEN 1.0 ELSE 0.0 END) AS trg2src FROM (
  SELECT *, row_number() OVER (PARTITION BY model, tgt_id ORDER BY cos DESC, src_id) AS rn FROM cosines)
  WHERE rn = 1 GROUP BY ALL),
acc AS (SELECT model, src2trg, trg2src, (src2trg + trg2src) / 2 AS accuracy FROM fw JOIN bw USING (model))
"""

FIX_SIDES = """
sides AS (
  SELECT lang_pair, model, split, sent_id, vec, 'src' AS side FROM src
  UNION ALL SELECT lang_pair, model, split, sent_id, vec, 'tgt' AS side FROM tgt)
"""

TOKEN_BOUNDS = "b AS (SELECT label, min(vec_id) AS f, max(vec_id) AS l, count(*) AS n FROM embeddings GROUP BY ALL)"

GRAM = (RAW.strip() + ",\n" + INDEP.strip() + ",\n" + SPLIT.strip() + """,
train AS (SELECT z.pair, z.ord, z.english, z.non_english FROM zipped z JOIN split s USING (pair, ord)
          WHERE s.part = 'train'),
rows_u AS (
  SELECT pair || ':' || ord::VARCHAR || ':e' AS rid, pair || ':' || ord::VARCHAR AS lid,
         english AS text FROM train
  UNION ALL
  SELECT pair || ':' || ord::VARCHAR || ':o' AS rid, pair || ':' || ord::VARCHAR AS lid,
         non_english AS text FROM train),
labsrc AS (SELECT pair || ':' || ord::VARCHAR AS lid, english FROM train),
""" + hashed("rows_u", "rid", "text", "xs").strip() + ",\n" + hashed("labsrc", "lid", "english", "ys").strip() + """,
xr AS (SELECT x.rid, u.lid, x.dim_idx, x.value FROM xs x JOIN rows_u u USING (rid)),
usable AS (SELECT DISTINCT x.rid FROM xr x JOIN ys y ON y.lid = x.lid)
""")

ORACLE = {
    "hashed_ngram_encode": _with(hashed("documents", "doc_id", "text", "h")) + """
SELECT doc_id, dim_idx, round(value, 6) AS value FROM h""",
    "encode": _with(hashed("documents", "doc_id", "text", "h")) + """
SELECT doc_id, dim_idx, round(value, 6) AS value FROM h""",
    "encode_resumed": _with(hashed("documents", "doc_id", "text", "h")) + """
SELECT doc_id, dim_idx, round(value, 6) AS value FROM h""",
    "encode_lang": _with(hashed("(SELECT doc_id, lang || ':' || text AS text FROM documents)", "doc_id", "text", "h")) + """
SELECT h.doc_id, d.lang, dim_idx, round(value, 6) AS value FROM h JOIN documents d USING (doc_id)""",
    "teacher_labels": _with(RAW, INDEP, hashed("(SELECT pair || '|' || ord::VARCHAR AS k, pair, ord, english FROM zipped)",
                                                "k", "english", "h")) + """
SELECT split_part(k, '|', 1) AS pair, split_part(k, '|', 2)::BIGINT AS ord, dim_idx, round(value, 6) AS value FROM h""",
    "mean_pool": _with(TOKEN_BOUNDS) + """,
t AS (SELECT e.label, e.embedding FROM embeddings e JOIN b USING (label) WHERE e.vec_id <> b.f AND e.vec_id <> b.l),
x AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS dim_idx FROM t),
nt AS (SELECT label, count(*) AS n_tokens FROM t GROUP BY ALL)
SELECT label, n_tokens, dim_idx, round(avg(v), 6) AS value FROM x JOIN nt USING (label) GROUP BY ALL""",
    "drop_empty": _with(TOKEN_BOUNDS) + """
SELECT label, greatest(n - 2, 0) AS n_tokens, greatest(n - 2, 0) > 0 AS kept FROM b""",
    "quantise": _with(FIXTURE, FIX_SIDES) + """
SELECT model, side, sent_id, dim_idx, round(v, 6) AS value FROM (
  SELECT model, side, sent_id, unnest(vec) AS v, generate_subscripts(vec, 1) - 1 AS dim_idx FROM sides)""",
    "truncate_tokens": """
SELECT doc_id, array_to_string(string_split_regex(trim(text, ' '), '[\\t\\n\\x0b\\f\\r ]+')[1:128], ' ') AS text FROM documents""",
    "vec_header": _with(FIXTURE, FIX_SIDES) + """
SELECT lang_pair, model, split, side, count(*) AS n, max(len(vec)) AS dim FROM sides GROUP BY ALL""",
    "check_dims": _with(FIXTURE, FIX_SIDES) + """
SELECT model, side, sum(CASE WHEN len(vec) = CASE model WHEN 'm05' THEN 64 WHEN 'm10' THEN 768 END THEN 1 ELSE 0 END)::BIGINT AS n_ok,
       sum(CASE WHEN len(vec) = CASE model WHEN 'm05' THEN 64 WHEN 'm10' THEN 768 END THEN 0 ELSE 1 END)::BIGINT AS n_bad
FROM sides GROUP BY ALL""",
    "mse_eval": _with(TEACHER_STUDENT) + """
SELECT model, round(mse, 9) AS mse, round(-mse, 9) AS negative_mse FROM mse""",
    "translation_accuracy": _with(TEACHER_STUDENT) + """
SELECT model, src2trg, trg2src, accuracy FROM acc""",
    "combined_score": _with(TEACHER_STUDENT) + """
SELECT model, round(-mse, 9) AS negative_mse, round(accuracy, 9) AS accuracy,
       round((-mse + accuracy) / 2, 9) AS combined
FROM mse JOIN acc USING (model)""",
    "linear_student_gram": "WITH " + GRAM + """
, xtx AS (
  SELECT a.dim_idx AS i, b.dim_idx AS j, sum(a.value * b.value) AS xtx
  FROM xr a JOIN xr b USING (rid) WHERE a.rid IN (SELECT rid FROM usable) GROUP BY ALL),
xty AS (
  SELECT a.dim_idx AS i, y.dim_idx AS j, sum(a.value * y.value) AS xty
  FROM xr a JOIN ys y ON y.lid = a.lid GROUP BY ALL),
ij AS (SELECT i.range AS i, j.range AS j FROM range(64) i CROSS JOIN range(64) j)
SELECT ij.i, ij.j, round(coalesce(xtx, 0.0), 6) AS xtx, round(coalesce(xty, 0.0), 6) AS xty
FROM ij LEFT JOIN xtx USING (i, j) LEFT JOIN xty USING (i, j)""",
    "student_two_stage": "WITH " + GRAM + """
, xty AS (
  SELECT split_part(a.rid, ':', 1) AS pair, a.dim_idx AS i, y.dim_idx AS j, sum(a.value * y.value) AS xty
  FROM xr a JOIN ys y ON y.lid = a.lid GROUP BY ALL),
systems(system, last) AS (VALUES ('stage1', FALSE), ('single', TRUE), ('two-stage', TRUE), ('reused', TRUE)),
ij AS (SELECT i.range AS i, j.range AS j FROM range(64) i CROSS JOIN range(64) j),
sums AS (SELECT pair = 'fr-de' AS last, i, j, sum(xty) AS xty FROM xty GROUP BY ALL)
SELECT system, ij.i, ij.j, round(coalesce(xty, 0.0), 6) AS xty, TRUE AS solved
FROM systems CROSS JOIN ij LEFT JOIN sums ON sums.last = systems.last AND sums.i = ij.i AND sums.j = ij.j
WHERE systems.last IN (SELECT last FROM sums)""",
    "run_labels": """
SELECT lang, mode, 'distil_' || mode || CASE mode WHEN 'two-stage' THEN CASE WHEN n % 2 = 0 THEN '_cs' || n || 'k' ELSE '_csAll' END || '_s1e1' ELSE '' END
       || '_s2e2_' || lang || CASE WHEN lang <> 'de' THEN '_small-student' ELSE '' END AS label
FROM (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang) CROSS JOIN (VALUES ('two-stage'), ('single-stage')) m(mode)""",
}
