"""Literal frames pinning the reference's semantics (quirks Q1-Q16 and the tie rules)."""

import math

import pytest
from pyspark.sql import functions as F

from lexalign.functions.grid import threshold_grid
from lexalign.operators.evaluate import apply_filter, evaluate
from lexalign.operators.sweep import best_threshold, sweep, transfer_summary

K = ["lang_pair", "model", "split"]
CAND = "lang_pair string, model string, split string, src_id string, tgt_id string, score double"
GOLD = "lang_pair string, split string, line_no long, src_id string, tgt_id string"


def _c(spark, rows):
    return spark.createDataFrame([("p", "m", "s", *r) for r in rows], CAND)


def _g(spark, rows, split="s"):
    return spark.createDataFrame([("p", split, i, a, b) for i, (a, b) in enumerate(rows)], GOLD)


def test_q1_duplicate_predictions_count(spark):
    preds = _c(spark, [("a", "x", 1.0), ("a", "x", 1.0), ("b", "y", 1.0)])
    r = evaluate(preds, _g(spark, [("a", "x")]), K).collect()[0]
    assert (r.tp, r.predicted, r.gold_n) == (2, 3, 1)
    assert r.recall == 2.0


def test_q2_gold_last_line_wins(spark):
    preds = _c(spark, [("a", "y", 1.0)])
    r = evaluate(preds, _g(spark, [("a", "x"), ("a", "y")]), K).collect()[0]
    assert (r.tp, r.gold_n) == (1, 1)


def test_q3_nan_never_passes(spark):
    c = _c(spark, [("a", "x", 0.9), ("b", "y", float("nan")), ("c", "z", 0.1)])
    assert apply_filter(c, 0.5, "static", K).count() == 1
    assert apply_filter(c, 0.1, "dynamic", K).count() == 0


def test_q5_grid_values():
    g = threshold_grid()
    assert len(g) == 50
    assert g[2][1] == 0.30000000000000004
    assert g[-1][1] == 4.999999999999998
    assert g[-1][2] == 5.0


def test_q6_single_score_std_zero(spark):
    c = _c(spark, [("a", "x", 1.0)])
    assert apply_filter(c, 0.1, "dynamic", K).count() == 0


def test_q11_unknown_method(spark):
    c = _c(spark, [("a", "x", 1.0)])
    with pytest.raises(ValueError):
        apply_filter(c, 0.1, "foo", K)
    with pytest.raises(ValueError):
        threshold_grid(0.1, 5.0, 0.0)


def test_ties_first_threshold_wins(spark):
    sw = spark.createDataFrame([("p", "m", "s", 0, 0.3, 0.3, 0.8, 0.8, 0.8), ("p", "m", "s", 1, 0.4, 0.4, 0.8, 0.8, 0.8),
                                ("p", "m", "s", 2, 0.5, 0.5, 0.5, 0.5, 0.5)],
                               "lang_pair string, model string, split string, idx int, raw double, threshold double, "
                               "precision double, recall double, f1 double")
    assert best_threshold(sw).collect()[0].threshold == 0.3


def _sweep_rows(spark, rows):
    return spark.createDataFrame(rows, "lang_pair string, model string, split string, idx int, raw double, "
                                       "threshold double, precision double, recall double, f1 double")


def test_nearest_threshold_and_gap(spark):
    rows = [("p", "m", "train", 0, 0.35, 0.35, 1.0, 1.0, 0.9),
            ("p", "m", "test", 0, 0.3, 0.3, 0.5, 0.5, 0.5), ("p", "m", "test", 1, 0.4, 0.4, 0.7, 0.7, 0.7)]
    s = transfer_summary(_sweep_rows(spark, rows)).collect()[0]
    # |0.3 - 0.35| and |0.4 - 0.35| are not exactly equal in binary; the smaller wins, else the first
    d0, d1 = abs(0.3 - 0.35), abs(0.4 - 0.35)
    expect = 0.5 if d0 <= d1 else 0.7
    assert s.test_f1_at_train_th == expect
    assert s.transfer_gap == pytest.approx(0.7 - expect)


def test_q15_grid_edge_flag(spark):
    rows = [("p", "m", "train", i, 0.1 * (i + 1), round(0.1 * (i + 1), 10), 1.0, 1.0, 1.0 - 0.1 * i) for i in range(3)]
    s = transfer_summary(_sweep_rows(spark, rows)).collect()[0]
    assert s.at_grid_edge is True
    assert s.test_best_f1 is None


def test_q16_other_splits_no_summary(spark):
    rows = [("p", "m", "dev", 0, 0.1, 0.1, 1.0, 1.0, 1.0), ("p", "m", "test", 0, 0.1, 0.1, 1.0, 1.0, 1.0)]
    assert transfer_summary(_sweep_rows(spark, rows)).count() == 0


def test_empty_candidates_give_zero_rows(spark):
    c = spark.createDataFrame([], CAND)
    groups = spark.createDataFrame([("p", "m", "s")], "lang_pair string, model string, split string")
    out = sweep(c, _g(spark, [("a", "x"), ("b", "y")]), groups=groups).collect()
    assert len(out) == 50
    assert all(r.precision == 0 and r.recall == 0 and r.f1 == 0 for r in out)


def test_q8_strip_unicode(spark):
    from lexalign.functions.text import strip_unicode

    s = " 　\u001ca\u0085  "
    assert spark.createDataFrame([(s,)], "t string").select(strip_unicode("t").alias("t")).first().t == "a"
    assert s.strip() == "a"


def test_q10_blank_line_modes(spark, tmpdir_path):
    from lexalign.sources.text import read_parallel_files

    other = f"{tmpdir_path}/o.txt"
    anchor = f"{tmpdir_path}/a.txt"
    open(other, "w").write("x1\n\nx2\n")
    open(anchor, "w").write("y1\ny2\ny3\n")
    ind = {(r.non_english, r.english) for r in read_parallel_files(spark, other, anchor).collect()}
    assert ind == {("x1", "y1"), ("x2", "y2")}
    pw = {(r.non_english, r.english) for r in read_parallel_files(spark, other, anchor, "pairwise").collect()}
    assert pw == {("x1", "y1"), ("x2", "y3")}


def test_q9_default_and_proxy_codes(spark):
    from lexalign.operators.catalog import models_df, resolve_lang_codes

    units = spark.createDataFrame([("sonar", "ru"), ("sonar", "es"), ("sonar", "hsb")], "model string, lang string")
    rows = {r.lang: r for r in resolve_lang_codes(units, models_df(spark)).collect()}
    assert rows["ru"].code == "eng_Latn" and rows["ru"].is_default
    assert rows["es"].code == "eng_Latn" and rows["es"].is_default
    assert rows["hsb"].code == "ces_Latn" and rows["hsb"].is_proxy and not rows["hsb"].is_default


def test_q13_empty_sentences_dropped(spark):
    from lexalign.operators.encode import empty_sentences, mean_pool

    toks = spark.createDataFrame([("s1", 0, [1.0, 1.0]), ("s1", 1, [9.0, 9.0]),
                                  ("s2", 0, [0.0, 0.0]), ("s2", 1, [2.0, 4.0]), ("s2", 2, [4.0, 8.0]),
                                  ("s2", 3, [0.0, 0.0])], "sid string, pos int, vec array<double>")
    pooled = {r.sid: r for r in mean_pool(toks, ["sid"]).collect()}
    assert set(pooled) == {"s2"}
    assert pooled["s2"].vec == [3.0, 6.0]
    rep = {r.sid: r.kept for r in empty_sentences(toks, ["sid"]).collect()}
    assert rep == {"s1": False, "s2": True}


@pytest.mark.parametrize("n,expected", [(25, 2), (20000, 1000)])
def test_eval_split_size(spark, n, expected):
    from lexalign.operators.parallel import train_eval_split

    df = spark.range(n).select(F.lit("x-de").alias("pair"), F.col("id").alias("ord"))
    out = train_eval_split(df).groupBy("part").count().collect()
    counts = {r.part: r["count"] for r in out}
    assert counts.get("eval", 0) == expected
    assert counts["train"] == n - expected


def test_q14_float_literals(spark):
    from lexalign.sources.text import parse_float

    df = spark.createDataFrame([("0.5d",), ("1e-3",), ("nan",), ("1_0",), (" 2.5 ",), ("abc",)], "s string")
    got = [r.v for r in df.select(parse_float(F.col("s")).alias("v")).collect()]
    assert got[0] is None and got[1] == 0.001 and math.isnan(got[2]) and got[3] == 10.0 and got[4] == 2.5
    assert got[5] is None
    for s in ("1e-3", "nan", "1_0", " 2.5 "):
        float(s)
    with pytest.raises(ValueError):
        float("0.5d")
