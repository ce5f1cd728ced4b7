"""Plan shape of the package's own queries: JVM-side sweep, group limits, windows over runs, pruned scans, lazy building."""

from lexalign.operators.sweep import sweep

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sweep_has_no_python(spark):
    c = spark.createDataFrame([("p", "m", "s", "a", "x", 0.5)],
                              "lang_pair string, model string, split string, src_id string, tgt_id string, score double")
    g = spark.createDataFrame([("p", "s", 0, "a", "x")],
                              "lang_pair string, split string, line_no long, src_id string, tgt_id string")
    plan = _plan(sweep(c, g))
    assert "Python" not in plan and "ArrowEval" not in plan


def test_split_keeps_a_group_limit_and_no_python(spark):
    from lexalign.plans.parallel_queries import train_eval

    plan = _plan(train_eval(spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Python" not in plan


def test_ordinals_window_over_runs(spark):
    from lexalign.operators.parallel import with_ordinal

    df = spark.range(0, 20000).selectExpr("id", "1 as one", "id % 2 as side")
    out = with_ordinal(df, ["side"], "id", "one")
    assert "_r1" in _plan(out)
    got = {r.id: r.offset for r in out.where("id in (0, 1, 8191, 8192, 19999)").collect()}
    assert got == {0: 0, 1: 0, 8191: 4095, 8192: 4096, 19999: 9999}


def test_lines_prune_columns(spark):
    from lexalign.plans.parallel_queries import parallel_lines

    plan = _plan(parallel_lines(spark, SF_SMALL))
    assert "IsNotNull(lang)" in plan and "source:string" not in plan and "n_chars" not in plan


def test_building_queries_starts_no_job(spark):
    import __spark_entry__ as E

    tracker = spark.sparkContext.statusTracker()
    for name in ("parallel_zip", "parallel_pairwise", "train_eval_split", "corpus_report", "teacher_labels", "quantise", "mean_pool",
                 "hashed_ngram_encode", "gold_last_wins", "parse_sentences"):
        spark.sparkContext.setJobGroup(f"build-{name}", "plan building")
        E.queries()[name](spark, SF_SMALL)
        stages = [k for j in tracker.getJobIdsForGroup(f"build-{name}") for k in tracker.getJobInfo(j).stageIds]
        # reading the schema of a Parquet file is a small job of Spark's reader
        assert all(tracker.getStageInfo(k).name.startswith("parquet") for k in stages), name
    spark.sparkContext.setJobGroup("", "")
