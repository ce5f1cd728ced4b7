"""Readers and writers: round trips and format rules."""

import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from lexalign.sources import sinks, text


def _write(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(body)


def test_read_lines_numbers_in_file_order(spark, tmpdir_path):
    p = f"{tmpdir_path}/big.txt"
    _write(p, "".join(f"line{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = text.read_lines(spark, p).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 5000
    assert all(r.value == f"line{r.line_no}" for r in rows)


def test_sentences_strict_and_quarantine(spark, tmpdir_path):
    p = f"{tmpdir_path}/c/hsb-de/hsb-de.train.hsb"
    _write(p, "s1\tHallo\ns2\tbad\tline\n")
    with pytest.raises(Exception):
        text.read_sentences(spark, p).collect()
    q = text.read_sentences(spark, p, on_bad="quarantine").orderBy("line_no").collect()
    assert [(r.sent_id, r.bad) for r in q] == [("s1", False), ("s2", True)]
    assert (q[0].lang_pair, q[0].split, q[0].lang) == ("hsb-de", "train", "hsb")


def test_gold_last_wins_from_file(spark, tmpdir_path):
    from lexalign.operators.evaluate import gold_last_wins

    p = f"{tmpdir_path}/hsb-de.test.gold"
    _write(p, "a\tx\nb\ty\na\tz\n")
    g = {r.src_id: r.gold_tgt for r in gold_last_wins(text.read_gold(spark, p)).collect()}
    assert g == {"a": "z", "b": "y"}


def test_candidates_extra_columns_and_bad_score(spark, tmpdir_path):
    p = f"{tmpdir_path}/hsb-de.test.m1.sim"
    _write(p, "a\tx\t0.5\textra\nb\ty\t1e-3\n")
    rows = text.read_candidates(spark, p).orderBy("line_no").collect()
    assert [(r.src_id, r.tgt_id, r.score, r.model) for r in rows] == [("a", "x", 0.5, "m1"), ("b", "y", 0.001, "m1")]
    bad = f"{tmpdir_path}/bad/hsb-de.test.m1.sim"
    _write(bad, "a\tx\t0.5d\n")
    with pytest.raises(Exception):
        text.read_candidates(spark, bad).collect()


def test_vec_round_trip_and_header(spark, tmpdir_path):
    vecs = spark.createDataFrame([("p", "s1", 0, [0.1234564, 1.0]), ("p", "s2", 1, [-0.5, 2.0]),
                                  ("p", "s3", 2, [3.0, 4.0])], "vset string, sent_id string, ord long, vec array<double>")
    out = f"{tmpdir_path}/vec"
    sinks.write_vec(vecs, out, ["vset"], "ord", partitions=2)
    files = sorted(glob.glob(f"{out}/vset=p/part-*"))
    body = "".join(open(f).read() for f in files).splitlines()
    assert body[0] == "3 2"
    assert body[1] == "s1 0.123456 1.000000"
    assert [b.split()[0] for b in body[1:]] == ["s1", "s2", "s3"]
    back = text.read_vec(spark, f"{out}/vset=p", per_directory=True).orderBy("line_no").collect()
    assert [r.sent_id for r in back] == ["s1", "s2", "s3"]
    assert back[2].vec == [3.0, 4.0]


def test_q4_vec_blank_last_line_and_header_mismatch(spark, tmpdir_path):
    p = f"{tmpdir_path}/x.vec"
    _write(p, "3 2\na 1.0 2.0\nb 3.0 4.0\n\n")
    assert text.read_vec(spark, p).count() == 2
    h = text.vec_header_check(spark, p).collect()[0]
    assert (h.header_n, h.rows, h.n_matches) == (3, 2, False)


def test_sweep_and_summary_csv(spark, tmpdir_path):
    from lexalign.operators.sweep import SUMMARY_COLUMNS, SWEEP_COLUMNS

    sw = spark.createDataFrame([("p", "m", "train", 0.1, 1.0, 0.5, 0.6666)],
                               "lang_pair string, model string, split string, threshold double, precision double, "
                               "recall double, f1 double")
    assert sinks.write_sweep(sw, f"{tmpdir_path}/sweep")
    f = glob.glob(f"{tmpdir_path}/sweep/part-*.csv")[0]
    rows = list(csv.reader(open(f)))
    assert rows[0] == SWEEP_COLUMNS
    summ = spark.createDataFrame([("p", "m", 0.1, 1.0, 1.0, 1.0) + (None,) * 8],
                                 ", ".join(f"{c} {'string' if c in ('lang_pair', 'model') else 'double'}"
                                           for c in SUMMARY_COLUMNS))
    assert sinks.write_summary(summ, f"{tmpdir_path}/summary")
    f = glob.glob(f"{tmpdir_path}/summary/part-*.csv")[0]
    rows = list(csv.reader(open(f)))
    assert rows[0] == SUMMARY_COLUMNS and rows[1][6:] == [""] * 8
    assert not sinks.write_sweep(sw.where(F.lit(False)), f"{tmpdir_path}/empty")


def test_q12_only_committed_outputs_count(spark, tmpdir_path):
    good = f"{tmpdir_path}/good"
    spark.range(3).write.parquet(good)
    partial = f"{tmpdir_path}/partial"
    os.makedirs(partial)
    open(f"{partial}/part-0000.parquet", "w").close()
    assert sinks.committed(spark, [good, partial]) == [good]


def test_predictions_and_candidates_writers(spark, tmpdir_path):
    c = spark.createDataFrame([("p", "m", "s", "a", "x", 0.5)],
                              "lang_pair string, model string, split string, src_id string, tgt_id string, score double")
    sinks.write_predictions(c, f"{tmpdir_path}/pred")
    f = glob.glob(f"{tmpdir_path}/pred/lang_pair=p/model=m/split=s/part-*")[0]
    assert open(f).read() == "a\tx\n"
    sinks.write_candidates(c, f"{tmpdir_path}/cand", fmt="tsv")
    f = glob.glob(f"{tmpdir_path}/cand/lang_pair=p/model=m/split=s/part-*")[0]
    assert open(f).read() == "a\tx\t0.5\n"
    sinks.write_candidates(c, f"{tmpdir_path}/candp")
    assert spark.read.parquet(f"{tmpdir_path}/candp").count() == 1


def test_quarantine_flags_short_lines(spark, tmpdir_path):
    p = f"{tmpdir_path}/q/hsb-de.test.gold"
    _write(p, "a\nb\ty\n")
    assert [(r.src_id, r.tgt_id, r.bad) for r in text.read_gold(spark, p, "quarantine").orderBy("line_no").collect()] == [
        ("a", None, True), ("b", "y", False)]
    p = f"{tmpdir_path}/q/hsb-de.test.m1.sim"
    _write(p, "a\tx\nb\ty\t0.5d\nc\tz\t2\n")
    got = text.read_candidates(spark, p, "quarantine").orderBy("line_no").collect()
    assert [(r.src_id, r.score, r.bad) for r in got] == [("a", None, True), ("b", None, True), ("c", 2.0, False)]


def test_exports_read_back_with_their_keys(spark, tmpdir_path):
    c = spark.createDataFrame([("hsb-de", "m1", "test", "a", "x", 0.5), ("oci-es", "m2", "train", "b", "y", 1.0)],
                              "lang_pair string, model string, split string, src_id string, tgt_id string, score double")
    sinks.write_candidates(c, f"{tmpdir_path}/cand", fmt="tsv")
    back = text.read_candidates(spark, f"{tmpdir_path}/cand/*/*/*")
    assert sorted(tuple(r) for r in back.select(*c.columns).collect()) == sorted(tuple(r) for r in c.collect())
    sinks.write_predictions(c, f"{tmpdir_path}/pred")
    back = text.read_predictions(spark, f"{tmpdir_path}/pred/*/*/*").select("lang_pair", "split", "src_id", "tgt_id")
    assert sorted(map(tuple, back.collect())) == [("hsb-de", "test", "a", "x"), ("oci-es", "train", "b", "y")]


def test_corpus_catalog_from_tree(spark, tmpdir_path):
    from lexalign.operators.catalog import corpus_catalog

    root = f"{tmpdir_path}/corpus"
    for f in ("hsb-de/hsb-de.train.hsb", "hsb-de/hsb-de.train.de", "hsb-de/hsb-de.test.hsb", "hsb-de/hsb-de.test.gold",
              "hsb-de/readme", "xx-yy/xx-yy.gold.gold"):
        _write(f"{root}/{f}", "a\tb\n")
    cat = {r.pair: r.splits for r in corpus_catalog(spark, root).collect()}
    assert cat == {"hsb-de": ["test", "train"]}


def test_writing_one_pair_leaves_the_others(spark, tmpdir_path):
    def rows(pair):
        return spark.createDataFrame([(pair, "m", "s", "a", "x", 0.5)], "lang_pair string, model string, split string, src_id string, tgt_id string, score double")

    for write, read in ((sinks.write_predictions, spark.read.text), (sinks.write_candidates, spark.read.parquet),
                        (lambda c, p: sinks.write_candidates(c, p, fmt="tsv"), spark.read.text),
                        (lambda c, p: sinks.write_labelled(c.select("lang_pair", F.col("src_id").alias("english"), F.col("tgt_id").alias("non_english"),
                                                                    F.array("score").alias("label")), p, partition_cols=["lang_pair"]), spark.read.parquet)):
        path = f"{tmpdir_path}/{id(write)}{id(read)}{len(os.listdir(tmpdir_path))}"
        write(rows("a-b"), path)
        write(rows("c-d"), path)
        write(rows("c-d"), path)
        assert sorted(r.lang_pair for r in read(path).collect()) == ["a-b", "c-d"]


def test_sweep_is_computed_once(spark, tmpdir_path):
    from lexalign.operators.sweep import SWEEP_COLUMNS

    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    types = ", ".join(f"{c} {'string' if c in ('lang_pair', 'model', 'split') else 'double'}" for c in SWEEP_COLUMNS)
    sw = spark.createDataFrame([("p", "m", "train", 0.1, 1.0, 0.5, 0.6)] * 3, types).mapInArrow(count, types)
    assert sinks.write_sweep(sw, f"{tmpdir_path}/sweep") and ran.value == 3
    assert sinks.write_sweep(sw, f"{tmpdir_path}/sweep")  # again, over the first
    assert spark.read.option("header", True).csv(f"{tmpdir_path}/sweep").count() == 3
    with pytest.raises(FileExistsError):
        sinks.write_sweep(sw, f"{tmpdir_path}/sweep", mode="errorifexists")
    assert sorted(os.listdir(tmpdir_path)) == ["sweep"]


def test_listing_and_pending_units(spark, tmpdir_path):
    from lexalign.sources import listing
    from lexalign.streaming.incremental import committed_units, pending_units

    spark.range(3).write.parquet(f"{tmpdir_path}/o/a/done")
    os.makedirs(f"{tmpdir_path}/o/b/part done")
    open(f"{tmpdir_path}/o/b/part done/part-0", "w").write("xyz")
    two = {(r.name, r.is_dir) for r in listing.tree(spark, f"{tmpdir_path}/o", 2).collect()}
    assert two == {("done", True), ("part done", True)}
    three = {r.name: r.size for r in listing.tree(spark, f"file:{tmpdir_path}/o/", 3).collect()}
    assert three["part-0"] == 3 and "_SUCCESS" in three
    assert listing.tree(spark, f"{tmpdir_path}/none", 1).count() == 0
    paths = ["a/done", "b/part done", "c/none", "a/done"]
    work = spark.createDataFrame([(i, f"{tmpdir_path}/o/{p}") for i, p in enumerate(paths)] + [(9, None)], "unit int, output_path string")
    assert sorted(r.unit for r in committed_units(spark, work).collect()) == [0, 3]
    assert sorted(r.unit for r in pending_units(spark, work, ["unit"]).collect()) == [1, 2, 9]
    assert sinks.committed(spark, []) == []
