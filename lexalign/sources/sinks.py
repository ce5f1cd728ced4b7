"""Writers (K1-K6).  Parquet partitioned by the group key is the working format; the text
formats of the reference pipeline are exports.

* ``write_vec`` (K1): per vector set a header ``n dim`` and ``id v1 ... vd`` lines with six
  decimals, in input order.  Rows are range-partitioned on (set, order), so a large set
  spans several part files whose name order is the line order; the header sorts first.
  (Java's ``%.6f`` rounds half-up on the shortest decimal form, Python on the binary
  value: the two can differ by one unit in the sixth decimal.)
* ``write_predictions`` (K2): ``src<TAB>tgt`` per group directory.
* ``write_sweep`` (K3) / ``write_summary`` (K4): CSV with the reference's fixed columns,
  written only when there are rows; missing values are blank.
* ``write_candidates`` (K5): Parquet by group, or ``src<TAB>tgt<TAB>score`` text.
* ``write_labelled`` (K6): Parquet ``(english, non_english, label)``.
* K2, K5 and K6 overwrite the key folders they have rows for and leave the others; ``unit_table`` adds commits.
* ``committed``: only outputs with a ``_SUCCESS`` marker count as done.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexalign.operators.sweep import SUMMARY_COLUMNS, SWEEP_COLUMNS
from lexalign.sources.listing import committed_paths
from lexalign.sources.units import UnitTable


def vec_lines(vecs: DataFrame, set_cols, order_col: str, id_col: str = "sent_id", vec_col: str = "vec") -> DataFrame:
    """``(set_cols, _o, value)``: the ``.vec`` text lines including one header per set (``_o`` = -1)."""
    set_cols = list(set_cols)
    body = vecs.select(*set_cols, F.col(order_col).cast("long").alias("_o"),
                       F.concat_ws(" ", F.col(id_col).cast("string"),
                                   F.array_join(F.transform(vec_col, lambda x: F.format_string("%.6f", x)), " "))
                       .alias("value"))
    head = vecs.groupBy(*set_cols).agg(
        F.concat_ws(" ", F.count(F.lit(1)).cast("string"), F.max(F.size(vec_col)).cast("string")).alias("value"))
    head = head.select(*set_cols, F.lit(-1).cast("long").alias("_o"), "value")
    return head.unionByName(body)


def write_vec(vecs: DataFrame, path: str, set_cols, order_col: str, id_col: str = "sent_id", vec_col: str = "vec",
              partitions: int | None = None, mode: str = "overwrite") -> None:
    lines = vec_lines(vecs, set_cols, order_col, id_col, vec_col)
    n = partitions or vecs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    (lines.repartitionByRange(int(n), *set_cols, "_o").sortWithinPartitions(*set_cols, "_o")
     .drop("_o").write.mode(mode).partitionBy(*set_cols).text(path))


def prediction_lines(preds: DataFrame, keys=("lang_pair", "model", "split")) -> DataFrame:
    """``(keys, value)``: ``src<TAB>tgt`` lines."""
    return preds.select(*keys, F.concat_ws("\t", F.col("src_id").cast("string"), F.col("tgt_id").cast("string")).alias("value"))


def write_predictions(preds: DataFrame, path: str, keys=("lang_pair", "model", "split"), mode: str = "overwrite"):
    keys = list(keys)
    _by_unit(prediction_lines(preds, keys), keys, mode).text(path)


def _by_unit(df: DataFrame, keys, mode: str):
    """A writer by key folders: overwriting replaces the folders that ``df`` has rows for and leaves the others."""
    return df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*keys)


def _csv(df: DataFrame, path: str, cols, mode: str) -> bool:
    """One run of the plan: rows are counted while they are written beside ``path``, which they then become."""
    spark, count = df.sparkSession, Observation()
    jvm = spark._jvm
    target, held = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path.rstrip('/')}.{uuid.uuid4().hex}"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if mode not in ("overwrite", "errorifexists", "error"):
        raise ValueError(f"unknown mode {mode!r}; expected 'overwrite' or 'errorifexists'")
    if mode != "overwrite" and fs.exists(target):
        raise FileExistsError(path)
    out = df.select(*cols).observe(count, F.count(F.lit(1)).alias("n")).coalesce(1)
    out.write.option("header", True).option("nullValue", "").option("emptyValue", "").csv(held.toString())
    if not count.get["n"]:
        fs.delete(held, True)
        return False
    fs.delete(target, True)
    if not fs.rename(held, target):
        raise OSError(f"could not move {held} to {target}")
    return True


def write_sweep(sweep_df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """K3: returns False (and writes nothing) for an empty sweep.  The sweep has 50 rows per
    group, so one output file is small."""
    return _csv(sweep_df, path, SWEEP_COLUMNS, mode)


def write_summary(summary: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """K4: one row per (lang_pair, model); test columns blank when there was no test sweep."""
    return _csv(summary, path, SUMMARY_COLUMNS, mode)


def write_candidates(cands: DataFrame, path: str, keys=("lang_pair", "model", "split"), fmt: str = "parquet",
                     mode: str = "overwrite") -> None:
    keys = list(keys)
    if fmt == "parquet":
        _by_unit(cands, keys, mode).parquet(path)
    elif fmt == "tsv":
        line = F.concat_ws("\t", *[F.col(c).cast("string") for c in ("src_id", "tgt_id", "score")])
        _by_unit(cands.select(*keys, line.alias("value")), keys, mode).text(path)
    else:
        raise ValueError(f"unknown candidate format {fmt!r}")


def write_labelled(labelled: DataFrame, path: str, mode: str = "overwrite", partition_cols=()) -> None:
    cols = list(partition_cols) + ["english", "non_english", "label"]
    out = labelled.select(*cols)
    (_by_unit(out, partition_cols, mode) if partition_cols else out.write.mode(mode)).parquet(path)


def committed(spark, paths) -> list[str]:
    """Q12: the subset of ``paths`` (a list of the caller's) that hold a ``_SUCCESS`` marker, looked up in tasks."""
    paths = list(paths)
    if not paths:
        return []
    done = {r[0] for r in committed_paths(spark.createDataFrame([(p,) for p in paths], "path string")).collect()}
    return [p for p in paths if p in done]


def unit_table(spark, path: str, keys=("lang_pair", "model", "split"), text: bool = False) -> UnitTable:
    """Outputs of many runs, unit by unit: each write is committed whole, and re-running a unit replaces that unit."""
    return UnitTable(spark, path, keys, "text" if text else "parquet")
