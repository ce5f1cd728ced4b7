"""Failed units, vectors without a language code, rows without an order key."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexalign.operators.encode import check_dims, encode
from lexalign.operators.isolate import isolate, run_units, settle
from lexalign.operators.parallel import numbered_lines, parallel_from_documents
from lexalign.sources.units import UnitTable

ROWS = [("a", 1), ("a", 2), ("b", 3), ("b", -1), (None, 4), ("c", 5)]


@pytest.fixture()
def _double():
    def double(part):
        if (part["x"] < 0).any():
            raise ValueError("negative")
        return part.assign(y=part["x"] * 2)

    return double


def test_one_failure_does_not_lose_the_run(spark, tmpdir_path, _double):
    rows = spark.createDataFrame(ROWS, "unit string, x int").repartition(4, "x")
    table = UnitTable(spark, f"{tmpdir_path}/t", ["unit"])
    table.write(spark.createDataFrame([("c", 9, 9)], "unit string, x int, y int"))
    work = spark.createDataFrame([("a",), ("b",), (None,), ("c",), ("empty",)], "unit string")
    status = {r.unit: (r.status, r.error) for r in run_units(rows, work, table, _double, "unit string, x int, y int").collect()}
    assert status == {"a": ("ran", None), "b": ("failed", "ValueError: negative"), None: ("ran", None), "c": ("done", None), "empty": ("skipped", None)}
    assert sorted(((r.unit, r.x, r.y) for r in table.read().collect()), key=repr) == sorted([("a", 1, 2), ("a", 2, 4), (None, 4, 8), ("c", 9, 9)], key=repr)
    again = {r.unit: r.status for r in run_units(rows.where("x > 0"), work, table, _double, "unit string, x int, y int").collect()}
    assert again == {"a": "done", "b": "ran", None: "done", "c": "done", "empty": "skipped"}


def test_all_rows_of_a_failed_unit_go(spark, _double):
    rows = spark.createDataFrame([("b", i - 5) for i in range(50)] + [("a", 1)], "unit string, x int").repartition(5, "x")
    good, failures = settle(isolate(rows, ["unit"], _double, "unit string, x int, y int"), ["unit"])
    assert [tuple(r) for r in good.collect()] == [("a", 1, 2)]
    assert [tuple(r) for r in failures.collect()] == [("b", "ValueError: negative")]
    good, failures = settle(isolate(rows.where("x > 99"), ["unit"], _double, "unit string, x int, y int"), ["unit"])
    assert good.count() == failures.count() == 0


def test_encode_without_a_language_code(spark):
    def factory():
        return lambda texts, lang: np.array([[len(t), -1 if lang is None else len(lang)] for t in texts], float)

    df = spark.createDataFrame([(1, "x", "deu"), (2, "yy", None), (3, "zzz", "fr"), (4, "", None)], "id int, text string, lang string").coalesce(1)
    got = {r.id: list(r.vec) for r in encode(df, "text", factory, 2, lang_col="lang", batch_size=1).collect()}
    assert got == {1: [1, 3], 2: [2, -1], 3: [3, 2], 4: [0, -1]}
    none = encode(df.where("lang is null"), "text", factory, 2, lang_col="lang").collect()
    assert sorted(r.id for r in none) == [2, 4]


def test_dims_can_fail(spark):
    vecs = spark.createDataFrame([("m", [1.0, 2.0]), ("m", [1.0])], "model string, vec array<double>")
    dims = spark.createDataFrame([("m", 2)], "model string, dim int")
    assert check_dims(vecs.limit(1), dims, on_bad="fail").count() == 1
    with pytest.raises(Exception, match="vector of 1 elements, but model m has 2"):
        check_dims(vecs, dims, on_bad="fail").count()
    with pytest.raises(ValueError):
        check_dims(vecs, dims, on_bad="no")


def test_null_ids_keep_ordinals(spark):
    docs = [(1, "de", "a\nb"), (None, "de", "x\ny"), (2, "de", "c"), (None, "de", "z"), (2, "de", "d"), (None, "fr", "q")]
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(3)
    lines = {r.ord: r.line for r in numbered_lines(df).where("side = 'de'").collect()}
    assert sorted(lines) == list(range(7)) and [lines[0], lines[1]] == ["a", "b"]
    assert {lines[2], lines[3]} == {"c", "d"} and {lines[4], lines[5], lines[6]} == {"x", "y", "z"}
    assert lines == {r.ord: r.line for r in numbered_lines(df.repartition(1)).where("side = 'de'").collect()}
    pairs = parallel_from_documents(df, "de").collect()
    assert [(r.pair, r.ord, r.english, r.non_english) for r in pairs] == [("fr-de", 0, "a", "q")]
    assert parallel_from_documents(df.limit(0), "de").count() == 0


def test_many_rows_without_an_id(spark):
    df = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("de").alias("lang"), F.col("id").cast("string").alias("text"))
    rows = numbered_lines(df).collect()
    assert sorted(r.ord for r in rows) == list(range(3000)) and len({r.line for r in rows}) == 3000


def test_report_has_every_status(spark):
    from conftest import SF_SMALL
    from lexalign.plans.catalog_queries import run_report_q

    assert {r.status for r in run_report_q(spark, SF_SMALL).collect() if r.units} == {"done", "failed", "ran", "skipped"}
