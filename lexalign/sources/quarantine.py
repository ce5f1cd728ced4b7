"""Good rows, bad rows and their counts from one scan (S1, S3-S6 with ``on_bad='quarantine'``).

``divert`` writes a parsed table once, in two folders: rows that follow the format and those that do not.  The counts are
observed while the rows are written, so neither the source nor the outputs are read for them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


@dataclass
class Diverted:
    good: DataFrame
    bad: DataFrame
    n_good: int
    n_bad: int


def divert(parsed: DataFrame, path: str, most_bad: float | None = None, flag: str = "bad") -> Diverted:
    """Write ``parsed`` (a reader's quarantine result with the boolean ``flag``) below ``path`` and read both parts back.

    A null flag counts as bad.  ``most_bad``: fail (after the write, so that the rows can be looked at) if more than
    this share of the rows is bad."""
    spark, seen = parsed.sparkSession, Observation()
    bad = F.coalesce(F.col(flag), F.lit(True))
    rows = parsed.withColumn(flag, bad).observe(seen, F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(flag), 1)).alias("n_bad"))
    rows.write.partitionBy(flag).parquet(path)
    n, n_bad = seen.get["n"], seen.get["n_bad"]
    if most_bad is not None and n_bad > most_bad * n:
        raise ValueError(f"{n_bad} of {n} rows are bad (at most {most_bad:.2%} may be); see {path}/{flag}=true")
    # folders are the flag, so each part opens its own files only
    both = spark.read.schema(rows.schema).parquet(path) if n else spark.createDataFrame([], rows.schema)
    return Diverted(both.where(~F.col(flag)).drop(flag), both.where(F.col(flag)).drop(flag), n - n_bad, n_bad)
