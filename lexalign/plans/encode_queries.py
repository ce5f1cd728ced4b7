"""Encoder, vector-set and distillation queries.

Vectors are reported in long form ``(keys, dim_idx, value)`` so that every element is
checked; values are rounded to 6 decimals (the ``.vec`` precision).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.functions.vectors import as_double
from lexalign.operators import cg
from lexalign.operators.distill import (combined_score, gram_statistics, label_with_teacher, mse_eval, run_label,
                                        training_rows, translation_accuracy)
from lexalign.operators.encode import (check_dims, empty_sentences, encode, hashed_ngram_udf, long_form, mean_pool,
                                       quantise_vectors, truncate_tokens, vec_header)
from lexalign.operators.catalog import model_registry
from lexalign.operators.util import for_heavy_rows
from lexalign.plans.parallel_queries import parallel_zip, split_corpus
from lexalign.session import checkpoint_dir, scratch_path
from lexalign.sources.fixtures import KEYS, MODELS, SHIFT, bilingual_fixture, table
from lexalign.streaming.resume import encode_ranges, encoded

FIXTURE_DIM = 64


def _encoder():
    # the encoder stage runs Arrow-batched, like model inference, on whole texts; the equal
    # Catalyst form (hashed_ngram_vector) is several times slower on long documents
    return hashed_ngram_udf()


def hashed_ngram_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = for_heavy_rows(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", _encoder()(F.col("text")).alias("vec"))
    return long_form(docs, ["doc_id"], nonzero=True)


def _ngram_factory():
    """The stand-in encoder as a factory; a language code, if given, conditions the text."""
    import numpy as np

    from lexalign.operators.encode import hashed_ngram_batch

    def encode_batch(texts, lang):
        if lang is not None:
            texts = [f"{lang}:{t}" for t in texts]
        return np.array([np.zeros(FIXTURE_DIM) if v is None else v for v in hashed_ngram_batch(texts)])
    return encode_batch


def encode_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the batch encoder."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return long_form(encode(docs, "text", _ngram_factory, FIXTURE_DIM, element="double"), ["doc_id"], nonzero=True)


def encode_resumed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 with the flush interval: the run stops after two waves and goes on; rows as of one run."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    root = scratch_path(spark, "encode")
    flush = max(1, (docs.agg(F.max("doc_id")).first()[0] or 0) // 20)  # about twenty ranges, whatever the table's size
    ask = dict(order_col="doc_id", text_col="text", encoder_factory=_ngram_factory, dim=FIXTURE_DIM, flush=flush, ranges=5, element="double")
    encode_ranges(docs, root, stop_after=2, **ask)
    return long_form(encoded(encode_ranges(docs, root, **ask)), ["doc_id"], nonzero=True)


def encode_lang_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a language code per row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    vecs = encode(docs, "text", _ngram_factory, FIXTURE_DIM, lang_col="lang", element="double")
    return long_form(vecs, ["doc_id", "lang"], nonzero=True)


def teacher_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = label_with_teacher(parallel_zip(spark, sf_dir), _encoder(), keys=["pair", "ord"])
    return long_form(lab.select("pair", "ord", "label"), ["pair", "ord"], vec_col="label", nonzero=True)


def _tokens(spark, sf_dir):
    # one "sentence" per label; its tokens are the label's rows in vec_id order
    return table(spark, sf_dir, "embeddings").select("label", F.col("vec_id").alias("pos"),
                                                     F.col("embedding").alias("vec"))


def mean_pool_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = mean_pool(_tokens(spark, sf_dir), ["label"])
    return long_form(pooled, ["label", "n_tokens"])


def drop_empty_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return empty_sentences(_tokens(spark, sf_dir), ["label"])


def quantise_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_form(quantise_vectors(_sides(spark, sf_dir)), ["model", "side", "sent_id"], digits=None)


def _sides(spark, sf_dir):
    src, tgt, _ = bilingual_fixture(spark, sf_dir)
    return src.withColumn("side", F.lit("src")).unionByName(tgt.withColumn("side", F.lit("tgt")))


def vec_header_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vec_header(_sides(spark, sf_dir), KEYS + ["side"])


def check_dims_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the registry says 768 or 1024, the fixture's vectors have 64 elements; m15 has no entry at all
    dims = (model_registry(spark).where(F.col("name") == "labse").select(F.lit("m10").alias("model"), "dim")
            .unionByName(spark.createDataFrame([("m05", FIXTURE_DIM)], "model string, dim int")))
    checked = check_dims(_sides(spark, sf_dir), dims)
    return checked.groupBy("model", "side").agg(F.sum(F.col("dim_ok").cast("long")).alias("n_ok"),
                                                F.sum((~F.col("dim_ok")).cast("long")).alias("n_bad"))


def _teacher_student(spark, sf_dir):
    """Teacher = embedding; student = embedding + alpha * embedding of row (vec_id + SHIFT) % n."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = emb.select(F.count(F.lit(1))).scalar()
    other = emb.select(F.col("vec_id").alias("other_id"), F.col("embedding").alias("other"))
    models = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(float(a)).alias("alpha"))
                                 for m, a in MODELS])).alias("m")
    return (emb.withColumn("other_id", F.pmod(F.col("vec_id") + SHIFT, n)).join(other, "other_id")
            .select("vec_id", "embedding", "other", models)
            .select(F.col("m.model").alias("model"), F.col("vec_id").alias("sent_id"),
                    as_double("embedding").alias("teacher"),
                    F.zip_with(as_double("embedding"), as_double("other"),
                               lambda x, y: x + F.col("m.alpha") * y).alias("student")))


def mse_eval_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mse_eval(_teacher_student(spark, sf_dir), ["model"]).select(
        "model", F.round("mse", 9).alias("mse"), F.round("negative_mse", 9).alias("negative_mse"))


def _accuracy(spark, sf_dir):
    ts = _teacher_student(spark, sf_dir)
    src = ts.select("model", "sent_id", F.col("teacher").alias("vec"))
    tgt = ts.select("model", "sent_id", F.col("student").alias("vec"))
    return translation_accuracy(src, tgt, ["model"])


def translation_accuracy_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accuracy(spark, sf_dir)


def combined_score_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = combined_score(mse_eval(_teacher_student(spark, sf_dir), ["model"]), _accuracy(spark, sf_dir), ["model"])
    return c.select("model", *[F.round(x, 9).alias(x) for x in ("negative_mse", "accuracy", "combined")])


def student_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train part of the parallel corpus, both whole text columns towards the teacher label."""
    par = split_corpus(spark, sf_dir).where(F.col("part") == "train")
    lab = label_with_teacher(par, _encoder(), keys=["pair", "ord"])
    rows = for_heavy_rows(training_rows(lab, ["pair", "ord"]), "pair", "ord")
    return rows.withColumn("x", _encoder()(F.col("text")))


def truncate_tokens_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12, where the cap is the feature: the first 128 tokens of every text."""
    return table(spark, sf_dir, "documents").select("doc_id", truncate_tokens(F.col("text")).alias("text"))


def linear_student_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gram_statistics(student_training_rows(spark, sf_dir), "x", "label")
    return (g.select("i", F.posexplode(F.arrays_zip("xtx", "xty")).alias("j", "v"))
            .select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
                    F.round("v.xtx", 6).alias("xtx"), F.round("v.xty", 6).alias("xty")))


#: the pair that stage 2 is trained on; stage 1 takes all others
STAGE2_PAIR = "fr-de"
STUDENT_BLOCK = 32


def student_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 by conjugate gradients: stage 1, stage 2 shrunk towards it, stage 2 with the stored stage 1, and stage 2 alone.

    Returns ``X'Y`` of every system and whether ``(X'X + I) W - P`` equals it within 1e-6: the normal equations."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    checkpoint_dir(spark)
    by_pair = gram_statistics(student_training_rows(spark, sf_dir), "x", "label", ["pair"]).checkpoint()
    sums = [Summarizer.sum(array_to_vector(c)).alias(c) for c in ("xtx", "xty")]
    system = F.when(F.col("pair") == STAGE2_PAIR, "single").otherwise("stage1").alias("system")
    gram = by_pair.groupBy(system, "i").agg(*sums).select("system", "i", vector_to_array("xtx").alias("xtx"), vector_to_array("xty").alias("xty"))
    gram = gram.checkpoint()
    first = cg.solve(gram, block=STUDENT_BLOCK, tol=1e-11)
    path = scratch_path(spark, "student")
    first.where("system = 'stage1'").write.parquet(path)
    stored = spark.read.parquet(path).select("i", "w")
    kinds = F.explode(F.array(F.lit("two-stage"), F.lit("reused"))).alias("system")
    prior = first.where("system = 'stage1'").select(F.lit("two-stage").alias("system"), "i", "w").unionByName(
        stored.select(F.lit("reused").alias("system"), "i", "w"))
    gram2 = gram.where("system = 'single'").select(kinds, "i", "xtx", "xty")
    second = cg.solve(gram2, prior=prior, block=STUDENT_BLOCK, tol=1e-11)
    sides = cg.normal_sides(gram, first, block=STUDENT_BLOCK).unionByName(cg.normal_sides(gram2, second, prior=prior, block=STUDENT_BLOCK))
    return sides.select("system", "i", "j", F.round("xty", 6).alias("xty"), (F.abs(F.col("left") - F.col("xty")) < 1e-6).alias("solved"))


def run_labels_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of a run per language and mode; a language with an even number of documents caps stage 1 at that many thousand."""
    n = table(spark, sf_dir, "documents").where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    modes = F.explode(F.array(F.lit("two-stage"), F.lit("single-stage"))).alias("mode")
    runs = n.select("lang", modes, F.when(F.col("n") % 2 == 0, F.col("n") * 1000 + 1).alias("cap"),
                    F.when(F.col("lang") != "de", F.lit("org/small-student")).alias("student"))
    label = run_label("mode", "cap", F.lit(1), F.lit(2), "lang", "student")
    return runs.select("lang", "mode", label.alias("label"))
