"""Shared plumbing: scratch tables in the cluster's shared folder, and a skew-safe join on group tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.session import checkpoint_dir


class Scratch:
    """Tables of one run under ``spark.checkpoint.dir``: written once, read many times, kept if executors go.

    Every run has a folder of its own, so nothing is overwritten.  ``drop`` removes a table that no later
    step reads; what the returned (lazy) result reads stays until the owner clears the folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/lexalign-{name}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
        w = df.write.mode("errorifexists")
        if by:
            w = w.partitionBy(*by)
        w.parquet(f"{self.path}/{name}")
        return self.load(name, df.schema)

    def load(self, name: str, schema=None) -> DataFrame:
        r = self.spark.read
        return (r.schema(schema) if schema is not None else r).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        for n in names:
            p = hadoop(f"{self.path}/{n}")
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def documents(df: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` and ``text`` alone: other columns, whatever their names, cannot clash with ours."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                     *[F.col(c) for c in extra])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def null_last(c: str | Column) -> Column:
    """A null id takes part as the largest id."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit((1 << 63) - 1))


def salted_join(rows: DataFrame, groups: DataFrame, on: list[str], by: str, salts: int = 16,
                how: str = "left") -> DataFrame:
    """Join many ``rows`` with one row per group: a hot group is spread over ``salts`` tasks by column ``by``.

    Only the (pre-aggregated) group side is replicated, so it should hold only the groups that matter.
    The salt is a hash of a column, so a task that is run again deals out the same rows.
    Spark sizes an exploded table as if it were not exploded and would broadcast it at ``salts`` times the threshold;
    the hint makes it a sort-merge join whatever the size, so nothing goes through the driver.
    """
    r = rows.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    g = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<int>")))
    return r.join(g.hint("merge"), [*on, "__salt"], how).drop("__salt")


def maybe_in(rows: DataFrame, keys: DataFrame, col: str, bits: int = 25) -> DataFrame:
    """Rows whose ``col`` may be among ``keys`` (a column of that name): a bitmap of hashes, ahead of a join on ``col``.

    Long texts that the join would drop anyway do not move.  The bitmap has ``2 ** bits`` bits whatever the number of
    keys (4 MB, at most 1024 rows), so it can be broadcast; if it fills up, rows pass that the join then drops.
    """
    place = F.pmod(F.xxhash64(col), F.lit(1 << bits))
    marks = keys.select(place.alias("__p")).groupBy(F.bitmap_bucket_number("__p").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__p")).alias("__bits"))
    r = rows.withColumn("__p", place).withColumn("__bucket", F.bitmap_bucket_number("__p"))
    at = F.bitmap_bit_position("__p")
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.get(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.floor(byte / F.pow(F.lit(2), i)) % 2), at % 8)
    return r.join(F.broadcast(marks), "__bucket").where(bit == 1).drop("__p", "__bucket", "__bits")


def map_texts(df: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work(batch) -> iterator of batches`` on the Arrow batches of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from work(b)

    return df.mapInArrow(run, schema)
