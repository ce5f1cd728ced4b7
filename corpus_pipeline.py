"""Corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing; each stage written and read again.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and, but for the last one, returns the
columns of ``docs``.  ``n_chars`` follows the text where a stage changes it.  Rows keep their own identity through a
stage, so repeated ids and null ids are handled row by row, as each operator defines it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm import decontaminate as DC
from lexalign.llm import line_dedup as LD
from lexalign.llm import near_dedup as ND
from lexalign.llm import packing as PK
from lexalign.llm import toxicity as TX
from lexalign.llm import words as W
from lexalign.llm.queries import tokenizer_spec
from lexalign.llm.tables import Scratch

#: a stage before packing has no SQL form, and neither has the whole
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity grammar rejects (score of at least 0.5) go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = TX.train(docs, labels, F.lit(False))
    return TX.keep(docs, model, 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 10 code points that several documents hold stay only in the smallest id."""
    return LD.clean(docs, min_chars=10, min_docs=2)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones (five-word shingles, 0.8) stays: the smallest id."""
    return ND.keep_one(docs, kind=W.ALNUM, n=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return DC.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return PK.pack(docs, tokenizer_spec(), end_id=1, seq=2048)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates),
          ("decontamination", drop_benchmark), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is a table in the shared folder, the one before it goes."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{k}_{name}")
        if k:
            scratch.drop(f"{k - 1}_{STAGES[k - 1][0]}")
    return docs
