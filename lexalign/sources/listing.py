"""Listing of shared folders, spread over tasks (J3): paths come and go as DataFrames, the driver lists nothing.

``children`` lists each folder of a table of folders in the task that holds it, ``tree`` goes down level by level and
deals every level anew, and ``markers`` looks for the ``_SUCCESS`` file of each path.  Tasks open the store with
``pyarrow.fs``, so paths must be of a kind it knows (local or mounted, ``hdfs``, ``s3``, ``gs``).  A folder that is
missing has no children and no marker.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUCCESS = "_SUCCESS"
_ENTRY = "path string, parent string, name string, is_dir boolean, size long, modified timestamp"


def _open(path: str):
    """The store of a path, and the path inside it.  ``file:/x`` (one slash) is how Spark writes local paths."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("/" + path[5:].lstrip("/") if path.startswith("file:") else path)


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for b in batches:
        for path in b.column(0).to_pylist():
            store, inside = _open(path)
            found = store.get_file_info(fs.FileSelector(inside, allow_not_found=True))
            base = path.rstrip("/")
            rows = sorted((x.base_name, x.type == fs.FileType.Directory, x.size, x.mtime) for x in found)
            yield pa.RecordBatch.from_arrays([
                pa.array([f"{base}/{r[0]}" for r in rows], pa.string()), pa.array([path] * len(rows), pa.string()),
                pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_()),
                pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.timestamp("us", "UTC"))],
                names=["path", "parent", "name", "is_dir", "size", "modified"])


def _dealt(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path")


def children(folders: DataFrame) -> DataFrame:
    """``(path, parent, name, is_dir, size, modified)`` of everything in the folders of column ``path``."""
    return _dealt(folders.select("path")).mapInArrow(_children, _ENTRY)


def tree(spark: SparkSession, root: str, depth: int) -> DataFrame:
    """Everything ``depth`` levels below ``root``."""
    level = spark.createDataFrame([(root,)], "path string")
    for k in range(depth):
        level = children(level if k == 0 else level.where("is_dir"))
    return level


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for b in batches:
        there = []
        for path in b.column(0).to_pylist():
            if path is None:
                there.append(False)
                continue
            store, inside = _open(f"{path.rstrip('/')}/{SUCCESS}")
            there.append(store.get_file_info(inside).type == fs.FileType.File)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(there, pa.bool_())], names=["path", "committed"])


def markers(paths: DataFrame) -> DataFrame:
    """``(path, committed)`` for every distinct path: whether a finished Spark write left its marker there."""
    return _dealt(paths.select("path").distinct()).mapInArrow(_marked, "path string, committed boolean")


def committed_paths(paths: DataFrame) -> DataFrame:
    return markers(paths).where(F.col("committed")).select("path")
