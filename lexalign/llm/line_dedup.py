"""Line dedup: explode normalised lines, hash them, count distinct documents per hash, drop the lines of
frequent hashes everywhere but in the smallest ``doc_id`` that has them, and reassemble by position.

Defined cases: a null or empty text is one empty line; repeated rows of a ``doc_id`` are one document for the
counts, and each row is cleaned; a null ``doc_id`` counts as one document, larger than all others; an empty table
gives an empty result; only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexalign.functions.vectors import let

from .tables import Scratch, documents, null_last, salted_join

#: ``[\x20\x09-\x0D]``
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """Blanks stripped at both ends and A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line_key(line)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def repeated_lines(docs: DataFrame, scratch: Scratch, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``id, tk, drop``: for each text (by its hash) of a document (null id: the largest) the positions, from 0, of the
    lines that it loses.

    The line table (36 bytes a line) is written once; counting and joining read that table, not the texts.
    Counting goes through (digest, document) first, so a line that a third of all documents share is counted
    by many tasks, and the join back deals such a line over salted tasks.
    """
    each = documents(docs).select(null_last("doc_id").alias("id"), F.xxhash64("text").alias("tk"),
                                  F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    lines = scratch.save(each.where(F.length(F.btrim("line", F.lit(BLANKS))) >= min_chars).select(
        "id", "tk", "pos", _digest(F.col("line")).alias("digest")), "lines")
    counts = (lines.groupBy("digest", "id").agg(F.lit(1).alias("one"))
              .groupBy("digest").agg(F.count("one").alias("n_docs"), F.min("id").alias("keeper"))
              .where(F.col("n_docs") >= min_docs).select("digest", "keeper"))
    hits = salted_join(lines, counts, ["digest"], "id", how="inner").where(F.col("id") != F.col("keeper"))
    return hits.groupBy("id", "tk").agg(F.collect_set("pos").alias("drop"))


def _with_drops(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """``docs`` with ``__drop``, the positions that the row's text loses (null: none)."""
    keyed = docs.withColumn("__id", null_last(F.col("doc_id").cast("long"))).withColumn(
        "__tk", F.xxhash64(F.col("text").cast("string")))
    return keyed.join(drops.select(F.col("id").alias("__id"), F.col("tk").alias("__tk"), F.col("drop").alias("__drop")),
                      ["__id", "__tk"], "left")


def _reassembled(text: Column, drop: Column) -> Column:
    """The text's lines at all positions but those of ``drop``, in order."""
    return F.array_join(let(_lines(text), lambda parts: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), drop), lambda k: F.get(parts, k))), "\n")


def clean(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``docs`` with all their columns; repeated lines are gone from ``text``, and ``n_chars``, if there, follows it.

    A text that keeps all its lines stays as it is (null too)."""
    scratch = Scratch(docs.sparkSession, "lines")
    d = _with_drops(docs, repeated_lines(docs, scratch, min_chars, min_docs))
    d = d.withColumn("text", F.when(F.col("__drop").isNull(), F.col("text")).otherwise(
        _reassembled(F.col("text"), F.col("__drop"))))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.col("__drop").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` per row, with the repeated lines gone from ``text``.

    A line counts when its key has at least ``min_chars`` code points; it goes when at least ``min_docs`` documents
    hold it, except from the smallest ``doc_id`` of them.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    d = _with_drops(documents(docs), repeated_lines(docs, scratch, min_chars, min_docs))
    text = F.coalesce("text", F.lit(""))
    return d.select("doc_id", F.size(_lines(text)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("__drop").isNull(), text).otherwise(_reassembled(text, F.col("__drop"))).alias("text"))
