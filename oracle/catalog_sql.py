"""DuckDB statements of the catalog and work-planning queries.  The model configuration
enters as VALUES rows (it is a parameter of the run)."""

from lexalign.plans.catalog_queries import CONFIG_MODELS


def _q(s):
    return "'" + str(s).replace("'", "''") + "'"


def _model_values():
    rows = [f"({_q(m.get('alias', m['name']))}, {i})" for i, m in enumerate(CONFIG_MODELS)]
    return "cfg(model, model_idx) AS (VALUES " + ", ".join(rows) + ")"


def _map_values():
    rows = []
    for m in CONFIG_MODELS:
        for lang, v in (m.get("lang_map") or {}).items():
            code, proxy, note = (v, False, "") if isinstance(v, str) else (v["code"], v.get("proxy", False), v.get("note", ""))
            rows.append(f"({_q(m.get('alias', m['name']))}, {_q(lang)}, {_q(code)}, {str(bool(proxy)).upper()}, {_q(note)})")
    return "lmap(model, lang, code, proxy, note) AS (VALUES " + ", ".join(rows) + ")"


SENT = """
tagged AS (
  SELECT vec_id, (['chv-ru', 'dsb-de', 'hsb-de', 'oci-es'])[(label % 4) + 1] AS lang_pair,
         CASE WHEN (vec_id // 10) % 2 = 0 THEN 'train' ELSE 'test' END AS split FROM embeddings),
sents AS (
  SELECT lang_pair, split, split_part(lang_pair, '-', 1) AS lang, vec_id AS sent_id FROM tagged WHERE vec_id % 5 <> 0
  UNION ALL
  SELECT lang_pair, split, split_part(lang_pair, '-', 2) AS lang, vec_id AS sent_id FROM tagged WHERE vec_id % 5 <> 1),
fnames AS (
  SELECT DISTINCT lang_pair AS pair, lang_pair || '.' || split || '.' || lang AS fname FROM sents
  UNION SELECT DISTINCT lang_pair AS pair, lang_pair || '.' || split || '.gold' AS fname FROM sents),
catalog AS (
  SELECT pair, list_sort(list_distinct(list(split_part(fname, '.', 2)))) AS splits FROM fnames
  WHERE len(string_split(fname, '.')) = 3 AND split_part(fname, '.', 3) <> 'gold' GROUP BY ALL)
"""


def _with(*parts):
    return "WITH " + ",\n".join(p.strip() for p in parts)


CODES = _with(SENT, _model_values(), _map_values()) + """,
units AS (SELECT lang_pair, lang, count(*) AS n_sentences FROM sents GROUP BY ALL),
codes AS (
  SELECT c.model, u.lang_pair, u.lang, coalesce(m.code, 'eng_Latn') AS code, coalesce(m.proxy, FALSE) AS is_proxy,
         m.code IS NULL AS is_default, coalesce(m.note, '') AS note, u.n_sentences
  FROM units u CROSS JOIN cfg c LEFT JOIN lmap m ON m.model = c.model AND m.lang = u.lang)
"""

STATUS = _with(SENT, _model_values()) + """,
work AS (
  SELECT 'embed' AS stage, c.model, k.pair AS lang_pair, s.split, l.lang
  FROM catalog k CROSS JOIN (SELECT unnest(splits) AS split, pair FROM catalog) s
  CROSS JOIN cfg c CROSS JOIN (SELECT pair, unnest(string_split(pair, '-')) AS lang FROM catalog) l
  WHERE s.pair = k.pair AND l.pair = k.pair),
avail AS (SELECT DISTINCT lang_pair, split, lang FROM sents),
done AS (SELECT DISTINCT m.model, s.lang_pair, s.split, s.lang FROM sents s
         CROSS JOIN (VALUES ('m05'), ('m10'), ('m15')) m(model)),
status AS (
  SELECT w.*, CASE WHEN a.lang IS NULL THEN 'skipped' WHEN d.model IS NOT NULL THEN 'done' ELSE 'ran' END AS status
  FROM work w
  LEFT JOIN avail a USING (lang_pair, split, lang)
  LEFT JOIN done d USING (model, lang_pair, split, lang))
"""

# a model with a language map fails on a language that the map lacks
RUN = STATUS.replace("WITH", "WITH " + _map_values() + ",", 1) + """,
sizes AS (SELECT lang_pair, split, lang, count(*) AS n FROM sents GROUP BY ALL),
run AS (
  SELECT s.*, n, CASE WHEN s.status = 'ran' AND s.model IN (SELECT model FROM lmap)
                   AND NOT EXISTS (SELECT 1 FROM lmap m WHERE m.model = s.model AND m.lang = s.lang) THEN 'failed' ELSE s.status END AS after
  FROM status s LEFT JOIN sizes USING (lang_pair, split, lang))
"""

ORACLE = {
    "corpus_catalog": _with(SENT) + "\nSELECT pair, array_to_string(splits, ',') AS splits FROM catalog",
    "select_pairs": _with(SENT) + """
SELECT pair, 'selected' AS status FROM catalog WHERE pair IN ('hsb-de', 'dsb-de', 'cs-de')
UNION ALL
SELECT r.pair, 'missing' AS status FROM (VALUES ('hsb-de'), ('dsb-de'), ('cs-de')) r(pair)
WHERE r.pair NOT IN (SELECT pair FROM catalog)""",
    "lang_codes": CODES + "SELECT * FROM codes",
    "proxy_report": CODES + "SELECT DISTINCT model, lang, code, note FROM codes WHERE is_proxy",
    "work_list": STATUS + "SELECT stage, model, lang_pair, split, lang FROM work",
    "pending_work": STATUS + "SELECT stage, model, lang_pair, split, lang FROM status WHERE status = 'ran'",
    "run_report": RUN + """
SELECT stage, after AS status, count(*) AS units FROM run GROUP BY ALL
UNION ALL
SELECT 'embed' AS stage, 'skipped' AS status, count(*) AS units
FROM cfg CROSS JOIN (VALUES ('test'), ('train')) s(split) CROSS JOIN (VALUES ('cs'), ('de')) l(lang)""",
    "failed_units": RUN + """
SELECT model, lang_pair, split, lang, after AS status, CASE after WHEN 'failed' THEN 'ValueError: no language code for ' || lang END AS error,
       CASE after WHEN 'ran' THEN n ELSE 0 END AS n_rows
FROM run WHERE status = 'ran'""",
}
