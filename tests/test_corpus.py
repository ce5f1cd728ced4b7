"""Splits drawn from sizes, run labels, and candidate tables that follow their input."""

import shutil

import pytest
from pyspark.sql import functions as F

from lexalign.operators.distill import run_label
from lexalign.operators.parallel import pair_sizes, parallel_from_documents, train_eval_split
from lexalign.plans import registered as R
from lexalign.sources.fixtures import table

from conftest import SF_MID, SF_SMALL


@pytest.mark.parametrize("most", [None, 70])
def test_split_from_sizes_is_the_split(spark, most):
    docs = table(spark, SF_MID, "documents")
    par = parallel_from_documents(docs, "de", max_sentences=most)
    sizes = pair_sizes(docs, "de", most)
    assert {tuple(r) for r in sizes.collect()} == {tuple(r) for r in par.groupBy("pair").count().collect()}
    cols = ["pair", "ord", "part", "english"]
    one = sorted(map(tuple, train_eval_split(par, cap_n=40, sizes=sizes).select(*cols).collect()))
    assert one == sorted(map(tuple, train_eval_split(par, cap_n=40).select(*cols).collect()))
    assert sum(r[2] == "eval" for r in one) == sum(min(40, int(0.1 * r.n)) for r in sizes.collect())
    assert pair_sizes(docs.where("lang <> 'de'"), "de").count() == 0


def test_run_labels(spark):
    rows = [("two-stage", 250_999, 3, 5, "dsb", "cis-lmu/glot500-base"), ("two-stage", None, 1, 1, "hsb", "a/b/c"), ("two-stage", 0, 1, 1, "x", "plain"),
            ("single-stage", 9, 1, 2, "chv", None)]
    df = spark.createDataFrame(rows, "mode string, cap int, e1 int, e2 int, lang string, student string")
    got = [r[0] for r in df.select(run_label("mode", "cap", "e1", "e2", "lang", "student")).collect()]
    assert got == ["distil_two-stage_cs250k_s1e3_s2e5_dsb", "distil_two-stage_csAll_s1e1_s2e1_hsb_c", "distil_two-stage_csAll_s1e1_s2e1_x_plain",
                   "distil_single-stage_s2e2_chv"]


def test_candidates_follow_rewritten_files(spark, tmpdir_path):
    path = f"{tmpdir_path}/sf"
    shutil.copytree(SF_SMALL, path)
    first = R.csls_mine(spark, path).count()
    table(spark, SF_SMALL, "embeddings").where(F.col("vec_id") < 200).coalesce(1).write.parquet(f"{path}/new")
    spark.read.parquet(f"{path}/new").write.mode("overwrite").parquet(f"{path}/embeddings.parquet")
    assert 0 < R.csls_mine(spark, path).count() < first
