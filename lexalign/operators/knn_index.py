"""Approximate nearest neighbours through a partitioned vector index (J5, ``strategy='index'``).

The exact join (``operators/knn``) multiplies every block of one side with every block of the other, so its work grows
with the product of both sides.  Here the target vectors of a group are dealt to cells, and a source vector is compared
with the cells nearest to it only:

1. **Centroids**: spherical k-means per group over a sample of at most ``SAMPLE`` vectors (those of smallest hash, so
   the same rows give the same centroids).  A group of ``n`` vectors gets about ``sqrt(n)`` cells, at most
   ``SAMPLE / 8``.  The sample only places centroids; every vector is indexed.
2. **Cells**: blocks of vectors meet the group's centroids in one Arrow task (one matrix product).  A target vector lands
   in its nearest cell, a source vector gets the list of its ``probes`` nearest ones.  Neither is copied per cell.
3. **Search**: the stripes of the exact join.  A task multiplies each cell of its target stripe with the source rows of
   its source stripe that name the cell, and keeps the best of all cells per source row, so what is shuffled does not grow
   with the probes.  The cosines of all that met are exact.  Cells of any size are spread over the stripes.

``probes`` trades work for recall (``probes = cells`` is the exact join); without it ``probes_for(cells)`` is used.  A row
meets about ``n * probes / cells`` others instead of ``n``.  Repeated ids, ties, zero and non-finite vectors behave as in
the exact join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexalign.operators.knn import (DEFAULT_BLOCK_ROWS, DEFAULT_CSLS_KNN, DEFAULT_K, METHODS, TILE, _arrow_types, _Grid,
                                    _lists, _prepare)
from lexalign.session import checkpoint_dir

SAMPLE = 8192
ROUNDS = 12
#: nearest targets that CSLS ranks, times max(k, csls_knn)
POOL = 4


def probes_for(cells: int) -> int:
    """Cells a source vector reads by default: 12 of 15, 23 of 40, 174 of 1024 (enough for vectors without clusters)."""
    return min(cells, int(np.ceil(2.2 * cells ** 0.63)))


def _train(keys, key_types):
    """One group's sample -> one row ``(keys, cells, centroids)`` with the centroids one after the other."""

    def run(table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        u = t.column("u").chunk(0) if t.num_rows else None
        x = u.flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
        n = min(int(t.column("cells")[0].as_py()), len(x))
        c = x[:n].copy()  # rows come by hash, so these are a random choice
        for _ in range(ROUNDS):
            near = (x @ c.T).argmax(1)
            total = np.zeros_like(c)
            np.add.at(total, near, x)
            size = np.linalg.norm(total, axis=1, keepdims=True)
            c = np.where(size > 0, total / np.where(size > 0, size, 1), c)
        cols = [pa.array([t.column(k)[0].as_py()], key_types[k]) for k in keys]
        return pa.table([*cols, pa.array([n], pa.int32()), pa.array([c.reshape(-1)], pa.list_(pa.float64()))],
                        names=[*keys, "cells", "centroids"])

    return run


def centroids(vecs: DataFrame, keys, cells: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """``(keys, cells, centroids)`` of prepared vectors ``(keys, id, u)``."""
    keys = list(keys)
    most = max(1, sample // 8)
    want = F.least(F.lit(most), F.ceil(F.sqrt(F.count(F.lit(1)))) if cells is None else F.lit(cells)).cast("int")
    # twice the sample has hashes below this share of their range, so only those are sorted
    share = F.least(F.lit(1.0), F.lit(2.0 * sample + 256) / F.count(F.lit(1)))
    sizes = vecs.groupBy(*keys).agg(want.alias("cells"), ((share - 0.5) * F.lit(2.0 ** 64)).alias("_most"))
    w = Window.partitionBy(*keys).orderBy("_h", "id")
    few = (vecs.withColumn("_h", F.xxhash64("id", "u")).join(sizes, keys).where(F.col("_h") <= F.col("_most"))
           .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= sample).select(*keys, "cells", "_rn", "u"))
    types = _arrow_types(vecs, keys)
    schema = ", ".join(f"`{k}` {vecs.schema[k].dataType.simpleString()}" for k in keys) + ", cells int, centroids array<double>"
    train = _train(keys, types)
    return few.groupBy(*keys).applyInArrow(lambda t: train(t.sort_by("_rn")), schema)


def _assign_fn(keys, schema: pa.Schema, probes, home: bool):
    """A block of vectors and its group's centroids -> the block with ``near``, nearest cell first."""

    def run(vecs: pa.Table, table: pa.Table) -> pa.Table:
        if not vecs.num_rows or not table.num_rows:
            return schema.empty_table()
        u = vecs.column("u").combine_chunks()
        x = u.flatten().to_numpy(zero_copy_only=False).reshape(len(u), -1)
        c = table.column("centroids").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, x.shape[1])
        n = 1 if home else min(len(c), probes or probes_for(len(c)))
        near = [np.argsort(-np.round(x[a:a + TILE] @ c.T, 10), axis=1, kind="stable")[:, :n].astype(np.int32) for a in range(0, len(x), TILE)]
        return vecs.select([f.name for f in schema if f.name != "near"]).append_column("near", _lists(np.vstack(near), pa.array)).cast(schema)

    return run


def _assigned(vecs: DataFrame, table: DataFrame, keys, probes, home: bool, block_rows: int) -> DataFrame:
    """Every vector ``(keys, row, id, u)`` with ``near``, its cells: blocks are the unit, so a hot group is spread over its blocks."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    at = [*keys, "blk"]
    blocks = vecs.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block_rows))).cast("int").alias("nb"))
    rows = vecs.join(blocks, keys).withColumn("blk", F.pmod(F.xxhash64("row"), F.col("nb")).cast("int")).drop("nb")
    beside = table.join(blocks, keys).select(*[F.col(c).alias(c) for c in (*keys, "centroids")], F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("blk"))
    types = StructType([*[vecs.schema[c] for c in (*keys, "row", "id", "u")], StructField("near", ArrayType(IntegerType()))])
    run = _assign_fn(keys, to_arrow_schema(types), probes, home)
    return rows.groupBy(*at).cogroup(beside.groupBy(*at)).applyInArrow(run, types)


def _numbered(df: DataFrame, keys, id_col: str, vec_col: str) -> DataFrame:
    return _prepare(df, keys, id_col, vec_col).withColumn("row", F.monotonically_increasing_id()).checkpoint()


class VectorIndex:
    """Target vectors by cell, and the centroids, both written to the shared checkpoint folder."""

    def __init__(self, tgt: DataFrame, keys, id_col: str = "sent_id", vec_col: str = "vec", cells: int | None = None,
                 sample: int = SAMPLE, block_rows: int = DEFAULT_BLOCK_ROWS):
        if sample < 1 or block_rows < 1 or (cells is not None and cells < 1):
            raise ValueError("cells, sample and block_rows must be positive")
        checkpoint_dir(tgt.sparkSession)
        self.keys, self.block_rows = list(keys), block_rows
        t = _numbered(tgt, self.keys, id_col, vec_col)
        self.centroids = centroids(t, self.keys, cells, sample).checkpoint()
        self.cells = _assigned(t, self.centroids, self.keys, None, True, block_rows).select(
            *self.keys, "row", "id", "u", F.col("near")[0].alias("cell")).checkpoint()

    def search(self, src: DataFrame, k: int, probes: int | None = None, id_col: str = "sent_id", vec_col: str = "vec") -> DataFrame:
        """``(keys, row, src_id, best)``: the ``k`` best targets in the probed cells of every source row, best first."""
        s = _numbered(src, self.keys, id_col, vec_col)
        asked = _assigned(s, self.centroids, self.keys, probes, False, self.block_rows).checkpoint()
        best = _Grid(asked, self.cells, self.keys, self.block_rows).best(k)
        return best.select(*self.keys, "row", F.col("id").alias("src_id"), "best")


def mine_indexed(src: DataFrame, tgt: DataFrame, keys=("lang_pair", "model", "split"), k: int = DEFAULT_K, method: str = "cosine",
                 csls_knn: int = DEFAULT_CSLS_KNN, cells: int | None = None, probes: int | None = None, id_col: str = "sent_id",
                 vec_col: str = "vec", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """The ``k`` best targets of every source row, as ``mine`` returns them, from probed cells.

    With ``method='csls'`` both neighbourhood means come from index searches too (the target's from an index over the
    sources), and the ``POOL * max(k, csls_knn)`` nearest targets of a source row are ranked by CSLS; rows that repeat a target
    id share the mean of their means."""
    if method not in METHODS:
        raise ValueError(f"unknown mining method {method!r}; expected one of {METHODS}")
    if k < 1 or csls_knn < 1 or (probes is not None and probes < 1):
        raise ValueError("k, csls_knn and probes must be positive")
    keys = list(keys)
    index = VectorIndex(tgt, keys, id_col, vec_col, cells, block_rows=block_rows)
    if method == "cosine":
        best = index.search(src, k, probes, id_col, vec_col)
        rows = best.select(*keys, "src_id", F.posexplode("best").alias("p", "b"))
        return rows.select(*keys, "src_id", F.col("b.id").alias("tgt_id"), (F.col("p") + 1).alias("rank"),
                           F.col("b.cos").alias("cos"), F.col("b.cos").alias("score")).checkpoint()

    def mean(best):
        near = F.slice("best", 1, csls_knn)
        return F.aggregate(near, F.lit(0.0), lambda acc, x: acc + x["cos"]) / F.size(near)

    ahead = index.search(src, POOL * max(k, csls_knn), probes, id_col, vec_col).withColumn("r_src", mean("best"))
    back = VectorIndex(src, keys, id_col, vec_col, cells, block_rows=block_rows).search(tgt, csls_knn, probes, id_col, vec_col)
    r_tgt = back.withColumn("r", mean("best")).groupBy(*keys, F.col("src_id").alias("tgt_id")).agg(F.avg("r").alias("r_tgt"))
    rows = ahead.select(*keys, "row", "src_id", "r_src", F.explode("best").alias("b")).withColumn("tgt_id", F.col("b.id"))
    score = 2 * F.col("b.cos") - F.col("r_src") - F.coalesce("r_tgt", F.lit(0.0))
    scored = rows.join(r_tgt, [*keys, "tgt_id"], "left").withColumn("score", score)
    w = Window.partitionBy(*keys, "row").orderBy(F.round("score", 10).desc(), "tgt_id")
    return (scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(*keys, "src_id", "tgt_id", "rank", F.col("b.cos").alias("cos"), "score")).checkpoint()


def recall(found: DataFrame, exact: DataFrame, keys) -> DataFrame:
    """``(keys, exact_n, found_n, recall)``: the share of the exact neighbours (by source and target id) that were found."""
    on = [*keys, "src_id", "tgt_id"]
    hit = exact.select(*on).distinct().join(found.select(*on).distinct().withColumn("_hit", F.lit(1)), on, "left")
    out = hit.groupBy(*keys).agg(F.count(F.lit(1)).alias("exact_n"), F.count("_hit").alias("found_n"))
    return out.withColumn("recall", F.col("found_n") / F.col("exact_n"))
