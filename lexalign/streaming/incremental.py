"""Re-run planning: which work units still need to run (J3 with Q12's commit rule)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexalign.operators.catalog import pending
from lexalign.sources.listing import committed_paths


def committed_units(spark, work: DataFrame, path_col: str = "output_path") -> DataFrame:
    """Units of ``work`` whose output path holds a committed Spark write.  Tasks look the paths up; a join brings the answer back."""
    done = committed_paths(work.select(F.col(path_col).alias("path")))
    return work.join(done.withColumnRenamed("path", path_col), path_col, "left_semi").select(*work.columns)


def pending_units(spark, work: DataFrame, keys, path_col: str = "output_path") -> DataFrame:
    """Units whose output is missing or was never committed (a partial write counts as missing)."""
    return pending(work, committed_units(spark, work, path_col), keys)
