"""Distillation data-prep queries over the ``documents`` table.

The anchor (teacher) side is German, the other sides are all other languages: each language's
documents, read in ``doc_id`` order and split into lines, stand for one line-aligned file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.operators.parallel import (corpus_report, numbered_lines, pair_sizes, parallel_from_documents,
                                         train_eval_split)
from lexalign.sources.fixtures import table

# Fixed values of the derived parallel corpus.
ANCHOR = "de"
CAP = 250


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "text")


def parallel_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept line of every language with its ordinal."""
    d = _docs(spark, sf_dir).where(F.col("lang").isNotNull())
    return numbered_lines(d).select(F.col("side").alias("lang"), "ord", "line")


def parallel_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parallel_from_documents(_docs(spark, sf_dir), ANCHOR)


def parallel_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parallel_from_documents(_docs(spark, sf_dir), ANCHOR, drop_blank="pairwise")


def parallel_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parallel_from_documents(_docs(spark, sf_dir), ANCHOR, max_sentences=CAP)


def split_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zipped corpus with its train and eval parts; sizes come from line counts, so the zip runs once."""
    return train_eval_split(parallel_zip(spark, sf_dir), sizes=pair_sizes(_docs(spark, sf_dir), ANCHOR))


def train_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_corpus(spark, sf_dir).select("pair", "ord", "part")


def corpus_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_report(split_corpus(spark, sf_dir))
