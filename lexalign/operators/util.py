"""Small plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def for_heavy_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-repartition (explicit count, which AQE does not coalesce) ahead of expensive
    per-row work such as an encoder: after a shuffle of a small table AQE may merge
    everything into a handful of partitions, leaving the encoder on a few cores.  The count
    follows ``spark.sql.shuffle.partitions``, i.e. the cluster's sizing."""
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *keys) if keys else df.repartition(n)
