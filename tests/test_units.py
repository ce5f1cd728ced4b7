"""Unit tables: units replace themselves alone, and nothing is seen before its commit."""

import os

import pytest
from pyspark.sql import functions as F

from lexalign.sources.units import UnitTable

KEYS = ["lang_pair", "model", "split"]
SCHEMA = "lang_pair string, model string, split string, src_id string, score double"


def _rows(df):
    return sorted((tuple(r) for r in df.select(*KEYS, "src_id", "score").collect()), key=repr)


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


A = [("a-b", "01", "train", "x", 0.5), ("a-b", "01", "train", "y", 1.5), ("a-b", "02", "test", "z", 2.5), (None, "01", "train", "n", 0.0)]


def test_one_unit_leaves_the_others(spark, tmpdir_path):
    t = UnitTable(spark, f"{tmpdir_path}/u", KEYS)
    assert t.read() is None and t.units() is None and t.versions() == []
    assert t.write(_frame(spark, A)) == 1
    again = [("a-b", "01", "train", "new", 9.0), ("c-d", "01", "train", "c", 3.0)]
    assert t.write(_frame(spark, again)) == 2
    assert _rows(t.read()) == sorted([*again, A[2], A[3]], key=repr)
    assert _rows(t.read(version=1)) == sorted(A, key=repr)
    got = {(r.lang_pair, r.model, r.split): (r.n_rows, r.version) for r in t.units().collect()}
    assert got == {("a-b", "01", "train"): (1, 2), ("c-d", "01", "train"): (1, 2), ("a-b", "02", "test"): (1, 1), (None, "01", "train"): (1, 1)}


def test_a_failed_write_is_not_seen(spark, tmpdir_path):
    t = UnitTable(spark, f"{tmpdir_path}/u", KEYS)
    t.write(_frame(spark, A))
    bad = _frame(spark, A).withColumn("score", F.when(F.col("src_id") == "z", F.raise_error(F.lit("broken row")).cast("double")).otherwise(7.0))
    with pytest.raises(Exception, match="broken row"):
        t.write(bad.repartition(3, "src_id"))
    staged = t.stage(_frame(spark, [("a-b", "01", "train", "never", 1.0)]))  # written whole, but the writer stops here
    assert _rows(t.read()) == sorted(A, key=repr) and t.versions() == [1]
    assert staged in t.vacuum()
    assert _rows(t.read()) == sorted(A, key=repr)
    assert [d for d in os.listdir(f"{tmpdir_path}/u/data") if staged in d] == []


def test_units_without_rows_are_done(spark, tmpdir_path):
    t = UnitTable(spark, f"{tmpdir_path}/u", KEYS)
    work = spark.createDataFrame([("a-b", "01", "train"), ("a-b", "03", "train"), (None, "01", "train"), ("e-f", "01", "test")],
                                 "lang_pair string, model string, split string")
    assert t.pending(work).count() == 4
    t.write(_frame(spark, A[:2]), units=work.where("model = '03'"))
    assert {tuple(r) for r in t.pending(work).collect()} == {(None, "01", "train"), ("e-f", "01", "test")}
    t.write(_frame(spark, A[:2]).where(F.lit(False)), units=work.where("lang_pair = 'a-b'"))  # a unit whose rows are gone
    assert t.read().count() == 0 and t.units().agg(F.sum("n_rows")).first()[0] == 0


def test_two_writers_get_two_versions(spark, tmpdir_path):
    a, b = (UnitTable(spark, f"{tmpdir_path}/u", KEYS) for _ in range(2))
    one, two = a.stage(_frame(spark, A[:2])), b.stage(_frame(spark, A[2:]))
    schema = _frame(spark, A).schema
    assert b.commit(two, schema) == 1 and a.commit(one, schema) == 2
    seen = a.versions
    a.versions = lambda: seen()[:1]  # a writer that has not seen the other's commit yet must not replace it
    later = a.stage(_frame(spark, A[:1]))

    def refresh():
        a.versions = seen
        return [1]

    a.versions = refresh
    assert a.commit(later, schema) == 3
    assert _rows(b.read()) == sorted([A[0], A[2], A[3]], key=repr)


def test_text_units(spark, tmpdir_path):
    t = UnitTable(spark, f"{tmpdir_path}/u", ["lang_pair"], fmt="text")
    t.write(spark.createDataFrame([("a-b", "x\ty"), ("c-d", "z")], "lang_pair string, value string"))
    t.write(spark.createDataFrame([("c-d", "w")], "lang_pair string, value string"))
    assert sorted(map(tuple, t.read().collect())) == [("a-b", "x\ty"), ("c-d", "w")]
    with pytest.raises(ValueError):
        UnitTable(spark, tmpdir_path, [])
    with pytest.raises(ValueError):
        UnitTable(spark, tmpdir_path, ["a"], fmt="orc2")
