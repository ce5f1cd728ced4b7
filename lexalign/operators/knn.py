"""Exact nearest-neighbour mining between a source and a target vector set.

Semantics
---------
Within every group ``keys`` (normally ``lang_pair, model, split``) each source vector is
compared with every target vector by cosine similarity.  With ``method='csls'`` the
score is the cross-domain similarity local scaling of Conneau et al. (2018)::

    csls(s, t) = 2 cos(s, t) - r_src(s) - r_tgt(t)

where ``r_src(s)`` is the mean cosine of ``s``'s ``knn`` nearest targets and ``r_tgt(t)``
the mean cosine of ``t``'s ``knn`` nearest sources.  ``method='cosine'`` scores by the
plain cosine.  Each source keeps its ``k`` best targets (score descending, target id
ascending on ties).  Zero vectors have no cosine and are dropped.

Rules
-----
* Rows are ranked one by one: rows that repeat an id (or are equal) each get their own ``k`` targets.
* Scores are compared after rounding to ``DIGITS`` decimals, then by target id, so repeated
  vectors tie however the work is cut.
* A vector with a NaN or infinite component fails the query; it is never ranked.

Plan
----
One path for groups of every size.  No pair of rows ever becomes a DataFrame row.  The rows of a side get numbers and
are dealt by them into stripes: ``STRIPE * block_rows`` rows of the source side, twice as many of the target side, fewer
if vectors are wide (``STRIPE_CELLS`` numbers a stripe).  Every stripe of one side meets every stripe of the other in
one Arrow task (a cogroup on ``(keys, source stripe, target stripe)``), and an aggregate merges the stripes.  A vector is
copied once per stripe of the other side, so what is shuffled follows the rows until a side fills several stripes.

A task multiplies tiles of ``TILE`` by ``block_rows`` in single precision, whose error has a bound, and keeps what may be
among the ``k`` best; only for those the cosine is worked out in double, and only that is ranked and returned.  Its memory
is two stripes, a tile and the ``k`` best of each row.  Pass 1 yields the neighbourhood means, pass 2 multiplies again with
the target means beside the target vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexalign.functions.vectors import as_double, normalize
from lexalign.session import checkpoint_dir

METHODS = ("csls", "cosine")
DEFAULT_K = 10
DEFAULT_CSLS_KNN = 20
DEFAULT_BLOCK_ROWS = 8192
#: source rows multiplied at a time, and decimals that scores are compared on
TILE = 512
DIGITS = 10
#: blocks of a source stripe (a target stripe has twice as many), and numbers that a stripe holds at most if a block has fewer
STRIPE = 8
STRIPE_CELLS = 1 << 23
#: columns that give a first bound, and pairs that are worked out in double at a time
AHEAD = 2048
PAIRS = 1 << 14


def _prepare(df: DataFrame, keys, id_col, vec_col) -> DataFrame:
    v = as_double(vec_col)
    finite = F.forall(v, lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    checked = F.when(finite, v).when(v.isNotNull(), F.raise_error(F.lit("vector with a non-finite component")).cast("array<double>"))
    return (df.select(*keys, F.col(id_col).alias("id"), normalize(checked).alias("u"))
            .where(F.col("u").isNotNull()))


def _stripe_counts(src, tgt, keys, block_rows):
    """``(keys, nb_s, nb_t)``: stripes of either side of the groups that have both."""
    def nb(df, name, blocks):
        wide = F.floor(F.lit(float(STRIPE_CELLS)) / F.greatest(F.max(F.size("u")), F.lit(1)))
        most = F.least(F.lit(float(blocks * block_rows)), F.greatest(F.lit(float(block_rows)), wide * (blocks // STRIPE)))
        return df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))
    return nb(src, "nb_s", STRIPE).join(nb(tgt, "nb_t", 2 * STRIPE), list(keys))


class _Best:
    """The ``k`` best of ``n`` rows so far: what may be among them is gathered, and cut to ``k`` a row when much has come.

    Equal scores (rounded) are ordered by column, so columns must be numbered in the order of their ids."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        #: no more than the k-th best score of a row
        self.least = np.full(n, -np.inf)
        self.kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0))
        self.new, self.size = [], 0

    def floor(self, rows, C: np.ndarray, slack: float) -> np.ndarray:
        """What a single-precision score of ``C`` (a line for each of ``rows``) must reach to be looked at."""
        fresh = np.flatnonzero(np.isinf(self.least[rows]))
        some = min(C.shape[1], max(AHEAD, 2 * self.k))
        if len(fresh) and some > self.k:
            first = np.partition(C[fresh, :some] if len(fresh) < len(C) else C[:, :some], some - self.k, axis=1)[:, some - self.k]
            at = np.arange(self.n)[rows][fresh]
            self.least[at] = first.astype(np.float64) - slack
        return (self.least[rows] - slack).astype(np.float32)

    def add(self, row, col, cos, score) -> None:
        self.new.append((row, col, cos, score))
        self.size += len(row)
        if self.size >= max(self.n * self.k, PAIRS):
            self.cut()

    def cut(self) -> None:
        row, col, cos, score = (np.concatenate(x) for x in zip(self.kept, *self.new))
        order = np.round(score, DIGITS)
        by = np.lexsort((col, -order, row))
        row = row[by]
        rank = np.arange(len(row)) - np.searchsorted(row, np.arange(self.n))[row]
        last = rank == self.k - 1
        self.least[row[last]] = order[by[last]]
        by = by[rank < self.k]
        self.kept = (row[rank < self.k], col[by], cos[by], score[by])
        self.new, self.size = [], 0


def _slack(d: int, most: float) -> float:
    """No sum of ``d`` products in single precision, of vectors whose products add up to ``most`` in size, is off by more."""
    return most * (d + 8) * 2.0 ** -23


def _cosines(S: np.ndarray, T: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    out = np.empty(len(row))
    for a in range(0, len(row), PAIRS):
        z = slice(a, a + PAIRS)
        out[z] = np.einsum("ij,ij->i", S[row[z]], T[col[z]])
    return out


def _places(mask: np.ndarray) -> np.ndarray:
    """Where ``mask`` (few of it true) is true, in its flat order: eight places are looked at together."""
    flat = mask.reshape(-1)
    if len(flat) % 8:
        return np.flatnonzero(flat)
    at = (np.flatnonzero(flat.view(np.uint64)) * 8)[:, None] + np.arange(8)
    return at[flat[at]]


def _multiply(S: np.ndarray, T: np.ndarray, k: int, sides: str, width: int, means: np.ndarray | None = None):
    """``(side, start, best)`` over all pairs: source rows by cosine, or ``2 cos - means`` of the target; target rows by cosine."""
    slack = _slack(S.shape[1] + 1, 1.0 if means is None else 3.0)
    S32, T32 = S.astype(np.float32), T.astype(np.float32)
    if means is not None:
        S32 = np.hstack([2 * S32, np.full((len(S), 1), -1, np.float32)])
        T32 = np.hstack([T32, means.astype(np.float32)[:, None]])
    tiles = [_Best(len(S[a:a + TILE]), k) for a in range(0, len(S), TILE)] if "s" in sides else []
    for c in range(0, len(T), width):
        block = T32[c:c + width].T
        over = _Best(block.shape[1], k)
        for i, a in enumerate(range(0, len(S), TILE)):
            C = S32[a:a + TILE] @ block
            for side, best in (("s", tiles[i] if tiles else None), ("t", over)):
                if side not in sides:
                    continue
                least = best.floor(slice(None), C if side == "s" else C.T, slack)
                row, col = np.divmod(_places(C >= (least[:, None] if side == "s" else least)), C.shape[1])
                if not len(row):
                    continue
                if len(row) * 16 > C.size:  # many equal ones: one product is less work
                    cos = (S[a:a + TILE] @ T[c:c + width].T)[row, col]
                else:
                    cos = _cosines(S, T, row + a, col + c)
                if side == "s":
                    best.add(row, col + c, cos, cos if means is None else 2.0 * cos - means[col + c])
                else:
                    best.add(col, row + a, cos, cos)
        if "t" in sides:
            yield "t", c, over
    for i, best in enumerate(tiles):
        yield "s", i * TILE, best


def _probe(S: np.ndarray, T: np.ndarray, k: int, near: pa.Array, cell: np.ndarray):
    """``(side, start, best)`` of source rows over the target rows in the cells that each row names in ``near``."""
    slack, best = _slack(S.shape[1], 1.0), _Best(len(S), k)
    asked = np.repeat(np.arange(len(near)), pc.list_value_length(near).to_numpy(zero_copy_only=False).astype(np.int64))
    names = near.flatten().to_numpy(zero_copy_only=False)
    by = np.argsort(names, kind="stable")
    asked, names = asked[by], names[by]
    home = np.argsort(cell, kind="stable")
    cells, start = np.unique(cell[home], return_index=True)
    S32, T32 = S.astype(np.float32), T.astype(np.float32)
    for name, a, z in zip(cells, start, [*start[1:], len(home)]):
        who = asked[np.searchsorted(names, name):np.searchsorted(names, name, side="right")]
        for c in range(a, z, DEFAULT_BLOCK_ROWS):
            cols = home[c:min(z, c + DEFAULT_BLOCK_ROWS)]
            block = T32[cols].T
            step = max(1, TILE * DEFAULT_BLOCK_ROWS // len(cols))
            for b in range(0, len(who), step):
                rows = who[b:b + step]
                C = S32[rows] @ block
                row, col = np.divmod(_places(C >= best.floor(rows, C, slack)[:, None]), len(cols))
                if len(row):
                    row, col = rows[row], cols[col]
                    cos = _cosines(S, T, row, col)
                    best.add(row, col, cos, cos)
    yield "s", 0, best


def _lists(m: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), kind(m.reshape(-1)))


def _vectors(t: pa.Table, *more: str):
    """Rows of a stripe in the order of their ids: ``(row numbers, ids, matrix, more columns)``."""
    by = pc.array_sort_indices(t.column("id").combine_chunks())
    row, ids, u, *rest = (t.column(c).combine_chunks().take(by) for c in ("row", "id", "u", *more))
    x = u.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return row, ids, x.reshape(len(ids), -1), rest


def _scan_fn(keys, k: int, sides: str, schema: pa.Schema, width: int):
    """Two stripes that meet -> a row for each of their vectors (of ``sides``) with the ``k`` best of the other stripe.

    Target rows may bring a mean (``r``) to be taken off, or a ``cell``, which source rows name in ``near``."""

    def run(src: pa.Table, tgt: pa.Table) -> pa.Table:
        if not src.num_rows or not tgt.num_rows:
            return schema.empty_table()
        s_row, s_ids, S, near = _vectors(src, *[c for c in ("near",) if c in src.column_names])
        t_row, t_ids, T, more = _vectors(tgt, *[c for c in ("cell", "r") if c in tgt.column_names])
        group = {c: src.column(c)[0].as_py() for c in keys}
        if near:
            found = _probe(S, T, k, near[0], more[0].to_numpy())
        else:
            found = _multiply(S, T, k, sides, width, more[0].to_numpy() if more else None)
        return pa.Table.from_batches([batch(group, side, start, best, *((s_row, s_ids, t_ids) if side == "s" else (t_row, t_ids, s_ids)))
                                      for side, start, best in found], schema)

    def batch(group, side, start, best, own_row, own_ids, others) -> pa.RecordBatch:
        best.cut()
        row, col, cos, score = best.kept
        cuts = pa.array(np.searchsorted(row, np.arange(best.n + 1)).astype(np.int32))
        cols = {c: pa.array([v] * best.n, schema.field(c).type) for c, v in group.items()}
        cols |= {"side": pa.array([side] * best.n), "row": own_row.slice(start, best.n)}
        if "top" in schema.names:
            cols["top"] = pa.ListArray.from_arrays(cuts, pa.array(cos))
        else:
            best_of = pa.StructArray.from_arrays([pa.array(-np.round(score, DIGITS)), others.take(pa.array(col)), pa.array(cos), pa.array(score)],
                                                 names=["neg", "id", "cos", "part"])
            cols |= {"id": own_ids.slice(start, best.n), "best": pa.ListArray.from_arrays(cuts, best_of)}
        return pa.RecordBatch.from_arrays([x if x.type == f.type else x.cast(f.type) for f, x in ((f, cols[f.name]) for f in schema)], schema=schema)

    return run


def _arrow_types(df, keys):
    from pyspark.sql.pandas.types import to_arrow_type
    return {k: to_arrow_type(df.schema[k].dataType) for k in keys}


class _Grid:
    """Two sides ``(keys, row, id, u)`` whose rows have numbers, and the plans over the pairs of their stripes."""

    def __init__(self, s: DataFrame, t: DataFrame, keys, block_rows: int):
        self.keys, self.s, self.t, self.block_rows = list(keys), s, t, block_rows
        self.counts = _stripe_counts(s, t, self.keys, block_rows)
        self.key_schema = ", ".join(f"`{k}` {s.schema[k].dataType.simpleString()}" for k in self.keys)
        self.id_type, self.other_type = (x.schema["id"].dataType.simpleString() for x in (s, t))

    @classmethod
    def of(cls, src, tgt, keys, id_col, vec_col, block_rows) -> _Grid:
        """Normalised sides, numbered once in the shared checkpoint folder."""
        checkpoint_dir(src.sparkSession)
        sides = (_prepare(x, list(keys), id_col, vec_col).withColumn("row", F.monotonically_increasing_id()).checkpoint() for x in (src, tgt))
        return cls(*sides, keys, block_rows)

    def _scan(self, t: DataFrame, k: int, sides: str, schema: str) -> DataFrame:
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType

        def dealt(df, own, n_own, other, n_other):
            rows = df.join(self.counts, self.keys).withColumn(own, F.pmod(F.xxhash64("row"), F.col(n_own)).cast("int"))
            rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))).drop("nb_s", "nb_t")
            return rows.select(*[F.col(c).alias(c) for c in rows.columns]).repartition(n, *pair)  # sides may share columns of one table

        spark, pair = t.sparkSession, [*self.keys, "sb", "tb"]
        n = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        s, t = dealt(self.s, "sb", "nb_s", "tb", "nb_t"), dealt(t, "tb", "nb_t", "sb", "nb_s")
        run = _scan_fn(self.keys, k, sides, to_arrow_schema(StructType.fromDDL(schema)), self.block_rows)
        return s.groupBy(*pair).cogroup(t.groupBy(*pair)).applyInArrow(run, schema)

    def means(self, knn: int) -> DataFrame:
        """``keys, side, row, r``: mean of the ``knn`` largest cosines of every vector."""
        part = self._scan(self.t, knn, "st", f"{self.key_schema}, side string, row long, top array<double>")
        top = F.slice(F.sort_array(F.flatten(F.collect_list("top")), asc=False), 1, knn)
        mean = F.aggregate("top", F.lit(0.0), lambda acc, x: acc + x) / F.size("top")
        return part.groupBy(*self.keys, "side", "row").agg(top.alias("top")).withColumn("r", mean).drop("top")

    def best(self, k: int, means: DataFrame | None = None, both: bool = False) -> DataFrame:
        """``keys, side, row, id, best``: the ``k`` best of the other side, best first."""
        t = self.t
        if means is not None:
            t = t.join(means.where("side = 't'").select(*self.keys, "row", "r"), [*self.keys, "row"])
        schema = (f"{self.key_schema}, side string, row long, id {self.id_type}, "
                  f"best array<struct<neg: double, id: {self.other_type}, cos: double, part: double>>")
        part = self._scan(t, k, "st" if both else "s", schema)
        merged = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k)
        return part.groupBy(*self.keys, "side", "row").agg(F.first("id").alias("id"), merged.alias("best"))


def neighbourhood_means(src: DataFrame, tgt: DataFrame, keys, knn: int = DEFAULT_CSLS_KNN,
                        id_col: str = "sent_id", vec_col: str = "vec", block_rows: int = DEFAULT_BLOCK_ROWS):
    """A5: ``(r_src, r_tgt)`` DataFrames ``(keys, sid|tid, r)``: mean cosine of each row's
    ``knn`` nearest rows on the other side of its group."""
    g = _Grid.of(src, tgt, keys, id_col, vec_col, block_rows)
    r = g.means(knn).checkpoint()  # both results read it
    on = g.keys + ["row"]
    r_src = r.where("side = 's'").join(g.s.select(*on, "id"), on).select(*g.keys, F.col("id").alias("sid"), "r")
    r_tgt = r.where("side = 't'").join(g.t.select(*on, "id"), on).select(*g.keys, F.col("id").alias("tid"), "r")
    return r_src, r_tgt


def nearest_both(src: DataFrame, tgt: DataFrame, keys, id_col: str = "sent_id", vec_col: str = "vec",
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``keys, side, id, near``: the most cosine-similar row of the other side for every row, from one product."""
    g = _Grid.of(src, tgt, keys, id_col, vec_col, block_rows)
    return g.best(1, both=True).select(*g.keys, "side", "id", F.col("best")[0]["id"].alias("near"))


def mine(src: DataFrame, tgt: DataFrame, keys=("lang_pair", "model", "split"), k: int = DEFAULT_K,
         method: str = "csls", csls_knn: int = DEFAULT_CSLS_KNN, id_col: str = "sent_id", vec_col: str = "vec",
         block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """J5 + A6 + W1: the ``k`` best targets of every source row.

    Returns ``(keys..., src_id, tgt_id, rank, cos, score)``; ``score`` is CSLS or cosine.  The candidates are
    checkpointed to the shared checkpoint folder (the ``.sim`` stage of the pipeline).
    """
    if method not in METHODS:
        raise ValueError(f"unknown mining method {method!r}; expected one of {METHODS}")
    if k < 1 or csls_knn < 1 or block_rows < 1:
        raise ValueError("k, csls_knn and block_rows must be positive")
    g = _Grid.of(src, tgt, list(keys), id_col, vec_col, block_rows)
    if method == "cosine":
        top = g.best(k).withColumn("r", F.lit(0.0))
    else:
        means = g.means(csls_knn).checkpoint()
        top = g.best(k, means).join(means.where("side = 's'"), g.keys + ["side", "row"])
    rows = top.select(*g.keys, F.col("id").alias("src_id"), "r", F.posexplode("best").alias("p", "b"))
    return rows.select(*g.keys, "src_id", F.col("b.id").alias("tgt_id"), (F.col("p") + 1).alias("rank"), F.col("b.cos").alias("cos"),
                       (F.col("b.part") - F.col("r")).alias("score")).checkpoint()
