"""Encoders (X1/X2 with a stub model), the ridge student (X5), labelled output (K6),
pair parsing (P1), registry (P8) and incremental re-runs (J3/Q12)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexalign.operators.catalog import model_registry, with_langs
from lexalign.operators.distill import apply_linear, gram_statistics, solve_ridge, two_stage
from lexalign.operators.encode import encode, hashed_ngram_batch, hashed_ngram_udf, hashed_ngram_vector


def test_encode_batches_and_language_codes(spark):
    def _stub_factory():
        # a "model": text length and a language-dependent constant, loaded once per worker
        import numpy as np

        def enc(texts, lang):
            off = 0.0 if lang is None else float(len(lang))
            return np.array([[len(t), off] for t in texts], dtype=np.float32)
        return enc

    df = spark.createDataFrame([(i, "x" * i, "deu_Latn" if i % 2 else "ces_Latn") for i in range(1, 50)],
                               "id int, text string, code string")
    out = {r.id: r.vec for r in encode(df, "text", _stub_factory, dim=2, lang_col="code", batch_size=7).collect()}
    assert out[3] == [3.0, 8.0] and out[4] == [4.0, 8.0]
    plain = {r.id: r.vec for r in encode(df, "text", _stub_factory, dim=2).collect()}
    assert plain[5] == [5.0, 0.0]
    with pytest.raises(Exception):
        encode(df, "text", _stub_factory, dim=3).collect()


def test_hashed_encoder_forms_agree(spark):
    texts = ["Guten Tag, Welt!", "ab", None, "Él habló de la casa", "x" * 500]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(hashed_ngram_vector(F.col("t")).alias("a"), hashed_ngram_udf()(F.col("t")).alias("b")).collect()
    ref = hashed_ngram_batch(texts)
    for r, w in zip(got, ref):
        if w is None:
            assert r.a is None and r.b is None
        else:
            assert np.allclose(r.a, w, atol=1e-12) and np.allclose(r.b, w, atol=1e-12)
            assert abs(np.linalg.norm(r.a) - 1) < 1e-12


def test_ridge_student_recovers_linear_map(spark):
    rng = np.random.default_rng(0)
    W = rng.normal(size=(4, 3))
    X = rng.normal(size=(400, 4))
    Y = X @ W
    df = spark.createDataFrame([(x.tolist(), y.tolist()) for x, y in zip(X, Y)], "x array<double>, y array<double>")
    g = gram_statistics(df.repartition(5), "x", "y")
    rows = sorted(g.collect(), key=lambda r: r.i)
    assert np.allclose(np.array([r.xtx for r in rows]), X.T @ X)
    assert np.allclose(np.array([r.xty for r in rows]), X.T @ Y)
    What = solve_ridge(g, lam=1e-9)
    assert np.allclose(What, W, atol=1e-6)
    pred = np.array([r.p for r in apply_linear(df, What, "x", "p").collect()])
    assert np.allclose(pred, Y, atol=1e-6)
    st = two_stage(df, df, "x", "y", lam=1e-6)
    assert np.allclose(st["stage2"], W, atol=1e-5)
    single = two_stage(None, df, "x", "y", lam=1e-6, mode="single-stage")
    assert "stage1" not in single
    with pytest.raises(ValueError):
        two_stage(None, df, "x", "y", mode="three-stage")


def test_write_labelled(spark, tmpdir_path):
    from lexalign.sources.sinks import write_labelled

    df = spark.createDataFrame([("hsb-de", "Hallo", "Witaj", [0.5, 0.5])],
                               "pair string, english string, non_english string, label array<double>")
    write_labelled(df, f"{tmpdir_path}/lab", partition_cols=["pair"])
    back = spark.read.parquet(f"{tmpdir_path}/lab").collect()[0]
    assert (back.english, back.non_english, back.label, back.pair) == ("Hallo", "Witaj", [0.5, 0.5], "hsb-de")


def test_with_langs_requires_two(spark):
    df = spark.createDataFrame([("hsb-de",)], "lang_pair string")
    r = with_langs(df).collect()[0]
    assert (r.src_lang, r.tgt_lang) == ("hsb", "de")
    with pytest.raises(Exception):
        with_langs(spark.createDataFrame([("a-b-c",)], "lang_pair string")).collect()


def test_model_registry_dims(spark):
    dims = {r.name: r.dim for r in model_registry(spark).collect()}
    assert dims["laser2"] == 1024 and dims["sonar"] == 1024 and dims["labse"] == 768


def test_incremental_pending_units(spark, tmpdir_path):
    from lexalign.streaming.incremental import pending_units

    done = f"{tmpdir_path}/u1"
    spark.range(1).write.parquet(done)
    work = spark.createDataFrame([("u1", done), ("u2", f"{tmpdir_path}/u2")], "unit string, output_path string")
    assert [r.unit for r in pending_units(spark, work, ["unit"]).collect()] == ["u2"]


def _constant(value):
    def factory():
        def encode_batch(texts, lang):
            return np.full((len(texts), 2), float(value))
        return encode_batch
    return factory


def test_each_factory_is_its_own_encoder(spark):
    df = spark.createDataFrame([(1, "a")], "id long, text string")
    assert [encode(df, "text", _constant(k), dim=2).first().vec[0] for k in range(6)] == [0, 1, 2, 3, 4, 5]
