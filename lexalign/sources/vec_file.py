"""One ``.vec`` file per vector set (K1), written by many tasks.

Every line's byte offset in its file is a prefix sum of line lengths (``with_ordinal``: windows over runs, none over a
whole set).  Lines are dealt to tasks by stretches of ``part_bytes``, and each task writes its stretches in place
(``pwrite``) into the set's file, whose size is known before.  A task that runs again writes the same bytes to the same
place.  The files grow in a folder beside ``root`` and are renamed to it once all bytes are there.

The folder must be mounted on all machines (a path or ``file:``): stores without writes at an offset get ordered part
files from ``write_vec`` instead.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexalign.operators.parallel import with_ordinal
from lexalign.sources.sinks import vec_lines

PART_BYTES = 32 << 20


def _local(path: str) -> str:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: one-file export needs a mounted folder; use write_vec")
    return path


def _placed(folder: str):
    """``mapInArrow`` over ``(name, offset, value, size)``, sorted: writes each stretch of neighbouring lines at once."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            names, offset, size = b.column(0), b.column(1).to_numpy(), b.column(3).to_numpy()
            ends = offset + size
            code = names.dictionary_encode().indices.to_numpy()
            first = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (offset[1:] != ends[:-1])))
            lines = pc.binary_join_element_wise(b.column(2).cast(pa.string()), pa.scalar(""), "\n")
            for a, z in zip(first, np.append(first[1:], b.num_rows)):
                f = os.open(f"{folder}/{names[int(a)].as_py()}", os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    data = memoryview("".join(lines.slice(a, z - a).to_pylist()).encode())
                    at = int(offset[a])
                    while data:
                        n = os.pwrite(f, data, at)
                        data, at = data[n:], at + n
                finally:
                    os.close(f)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(first)), pa.array(np.add.reduceat(size, first))], names=["name", "written"])

    return run


def write_vec_files(vecs: DataFrame, root: str, set_cols, order_col: str, id_col: str = "sent_id", vec_col: str = "vec",
                    part_bytes: int = PART_BYTES) -> None:
    """``root/<set values joined by dots>.vec`` for every set: a header line ``n dim`` and one line a vector, in order."""
    spark, set_cols = vecs.sparkSession, list(set_cols)
    target = _local(root.rstrip("/"))
    if os.path.exists(target):
        raise FileExistsError(target)
    held = f"{target}.{uuid.uuid4().hex}"
    os.makedirs(held)
    lines = vec_lines(vecs, set_cols, order_col, id_col, vec_col).withColumn("size", (F.octet_length("value") + 1).cast("long"))
    placed = with_ordinal(lines, set_cols, "_o", "size", "offset", tie="value")
    name = F.concat(F.concat_ws(".", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in set_cols]), F.lit(".vec"))
    rows = placed.select(name.alias("name"), "offset", "value", "size").withColumn("part", F.floor(F.col("offset") / part_bytes))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "name", "part").sortWithinPartitions("name", "offset").drop("part")
    written = dealt.mapInArrow(_placed(held), "name string, written long").groupBy("name").agg(F.sum("written").alias("written"))
    for r in written.collect():  # a row per file
        if os.path.getsize(f"{held}/{r['name']}") != r["written"]:
            raise OSError(f"{held}/{r['name']}: {os.path.getsize(held + '/' + r['name'])} bytes instead of {r['written']}")
    os.rename(held, target)
