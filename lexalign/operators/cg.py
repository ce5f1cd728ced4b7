"""Ridge systems too large for the driver (X5): conjugate gradients over row blocks of ``X'X``.

Solves ``(X'X + lam I) W = X'Y + lam P`` for every ``system`` (the key column; several are solved side by side).  ``X'X``
is kept as a grid of ``block`` x ``block`` matrices, everything else as row blocks of ``block`` x (columns of Y) beside
each other in one state table.  One round is one block product (a join of the grid with the direction's row blocks, and a
sum per row block), written to the checkpoint folder, and two sums per column over the state.  The driver holds those
sums, a few numbers per system and column, and never a matrix.

Columns of ``Y`` run side by side with step lengths of their own; the diagonal of ``X'X + lam I`` preconditions them.  A
column stops moving once its residual is at most ``tol`` times the norm of its right-hand side.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexalign.session import checkpoint_dir

BLOCK = 512
TOL = 1e-11
ROUNDS = 1000

_STATE = "system string, b int, m array<double>, w array<double>, r array<double>, p array<double>"


def _summed(df: DataFrame, keys, col: str) -> DataFrame:
    return df.groupBy(*keys).agg(Summarizer.sum(array_to_vector(col)).alias("_v")).select(*keys, vector_to_array("_v").alias(col))


def grid(gram: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(system, b, c, n_rows, n_cols, a)``: the blocks of ``X'X``, row by row, from ``gram_statistics`` rows."""
    cuts = F.sequence(F.lit(0), F.floor((F.size("xtx") - 1) / F.lit(block)).cast("int"))
    parts = F.transform(cuts, lambda c: F.struct(c.alias("c"), F.slice("xtx", c * block + 1, F.lit(block)).alias("v")))
    rows = gram.select("system", F.floor(F.col("i") / block).cast("int").alias("b"), "i", F.inline(parts))
    packed = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]))
    return rows.groupBy("system", "b", "c").agg(F.count(F.lit(1)).cast("int").alias("n_rows"), F.max(F.size("v")).alias("n_cols"), packed.alias("a"))


def row_blocks(rows: DataFrame, col: str, block: int = BLOCK) -> DataFrame:
    """``(system, b, <col>)``: rows ``(system, i, <col>)`` packed by block."""
    packed = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", col))), lambda x: x[col]))
    return rows.groupBy("system", F.floor(F.col("i") / block).cast("int").alias("b")).agg(packed.alias(col))


def _diagonal(a: DataFrame, lam: float) -> DataFrame:
    """``(system, b, m)``: the diagonal of ``X'X + lam I`` by block."""
    n = F.col("n_rows")
    return a.where("b = c").select("system", "b", F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.element_at("a", k * (n + 1) + 1) + lam).alias("m"))


def product(a: DataFrame, x: DataFrame, col: str) -> DataFrame:
    """``(system, b, <col>)``: ``X'X`` times the row blocks ``(system, b, <col>)``."""

    def run(batches):
        for t in batches:
            out = []
            for i in range(t.num_rows):
                left, right = (np.asarray(t.column(k)[i].values) for k in (4, 5))
                rows, cols = t.column(2)[i].as_py(), t.column(3)[i].as_py()
                out.append((left.reshape(rows, cols) @ right.reshape(cols, -1)).reshape(-1))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(out, pa.list_(pa.float64()))], names=["system", "b", col])

    pairs = (a.join(x.select("system", F.col("b").alias("c"), F.col(col).alias("x")), ["system", "c"])
             .select("system", "b", "n_rows", "n_cols", "a", "x"))
    return _summed(pairs.mapInArrow(run, f"system string, b int, {col} array<double>"), ["system", "b"], col)


def _blocks(t: pa.RecordBatch, i: int, names) -> list[np.ndarray]:
    """Row blocks of a state row as matrices; ``m`` (one number a row) gives their height."""
    rows = len(t.column("m")[i])
    return [np.asarray(t.column(n)[i].values).reshape(rows, -1) for n in names]


def _column_sums(state: DataFrame, names, fn) -> dict[str, np.ndarray]:
    """``fn`` of a row's blocks gives sums per column; they are added up per system.  One row a system reaches the driver."""

    def run(batches):
        for t in batches:
            out = [np.concatenate(fn(t.column("system")[i].as_py(), *_blocks(t, i, names))) for i in range(t.num_rows)]
            yield pa.RecordBatch.from_arrays([t.column("system"), pa.array(out, pa.list_(pa.float64()))], names=["system", "s"])

    got = _summed(state.mapInArrow(run, "system string, s array<double>"), ["system"], "s")
    return {r["system"]: np.array(r["s"]) for r in got.collect()}


def _mapped(state: DataFrame, names, fn) -> DataFrame:
    """State rows with ``(w, r, p)`` replaced by ``fn(system, blocks)``."""

    def run(batches):
        for t in batches:
            new = [fn(t.column("system")[i].as_py(), *_blocks(t, i, names)) for i in range(t.num_rows)]
            cols = [pa.array([x[k].reshape(-1) for x in new], pa.list_(pa.float64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([t.column("system"), t.column("b"), t.column("m"), *cols], names=["system", "b", "m", "w", "r", "p"])

    return state.mapInArrow(run, _STATE)


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros_like(a), where=b > 0)


def solve(gram: DataFrame, lam: float = 1.0, prior: DataFrame | None = None, block: int = BLOCK, tol: float = TOL, rounds: int = ROUNDS) -> DataFrame:
    """``(system, i, w)``: the weights, a row per feature.

    ``gram``: ``(system, i, xtx, xty)`` for ``i`` from 0 on without gaps; ``prior``: ``(system, i, w)``, which is also the
    starting point (without one both are zero)."""
    if lam <= 0 or block < 1:
        raise ValueError("lam and block must be positive")
    checkpoint_dir(gram.sparkSession)
    a = grid(gram, block).checkpoint()
    start = row_blocks(gram.select("system", "i", "xty"), "xty", block).join(_diagonal(a, lam), ["system", "b"])
    if prior is None:
        start = start.select("system", "b", "m", F.transform("xty", lambda x: F.lit(0.0)).alias("w"), F.col("xty").alias("r"), F.col("xty").alias("p"))
    else:  # X'Y + lam P - (X'X + lam I) P
        w = row_blocks(prior.select("system", "i", "w"), "w", block)
        gone = product(a, w, "w").withColumnRenamed("w", "g")
        left = F.zip_with("xty", "g", lambda x, y: x - y)
        start = start.join(w, ["system", "b"]).join(gone, ["system", "b"]).select(
            "system", "b", "m", "w", left.alias("r"), F.zip_with("xty", "w", lambda x, y: x + lam * y).alias("p"))

    state = _mapped(start, "mwrp", lambda s, m, w, r, p: (w, r, r / m)).checkpoint()
    first = _column_sums(state, "mr", lambda s, m, r: ((r * r / m).sum(0), (r * r).sum(0)))
    rz = {s: v[: len(v) // 2] for s, v in first.items()}
    left = {s: v[len(v) // 2:] for s, v in first.items()}
    # what residuals are measured by: the right-hand sides (held in p above) and the first residual
    rhs = _column_sums(start.select("system", "b", "m", "p"), "p", lambda s, p: ((p * p).sum(0),))
    size = {s: rhs[s] + left[s] for s in rhs}
    for _ in range(rounds):
        if all((left[s] <= tol * tol * size[s]).all() for s in left):
            break
        q = product(a, state.select("system", "b", "p"), "p").withColumnRenamed("p", "q")
        held = state.join(q, ["system", "b"]).select("system", "b", "m", "w", "r", "p", F.zip_with("q", "p", lambda x, y: x + lam * y).alias("q")).checkpoint()
        pq = _column_sums(held, "pq", lambda s, p, q: ((p * q).sum(0),))
        alpha = {s: _share(rz[s], pq[s]) for s in pq}

        def moved(s, m, r, q, alpha=alpha):
            r = r - alpha[s] * q
            return (r * r / m).sum(0), (r * r).sum(0)

        new = _column_sums(held, "mrq", moved)
        beta = {s: _share(v[: len(v) // 2], rz[s]) for s, v in new.items()}
        rz, left = {s: v[: len(v) // 2] for s, v in new.items()}, {s: v[len(v) // 2:] for s, v in new.items()}

        def step(s, m, w, r, p, q, alpha=alpha, beta=beta):
            r = r - alpha[s] * q
            return w + alpha[s] * p, r, r / m + beta[s] * p

        state = _mapped(held, "mwrpq", step)
    else:
        raise ArithmeticError(f"no convergence in {rounds} rounds")
    n = F.size("m")
    width = F.size("w") / n
    rows = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct((F.col("b") * block + k).alias("i"), F.slice("w", (k * width + 1).cast("int"), width.cast("int")).alias("w")))
    return state.select("system", F.inline(rows)).checkpoint()


def normal_sides(gram: DataFrame, weights: DataFrame, lam: float = 1.0, prior: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """``(system, i, j, left, xty)``: ``(X'X + lam I) W - lam P`` and ``X'Y`` cell by cell; a solution makes them equal."""
    own = row_blocks(weights.select("system", "i", "w"), "w", block)
    sides = product(grid(gram, block), own, "w").join(own.withColumnRenamed("w", "own"), ["system", "b"])
    sides = sides.join(row_blocks(gram.select("system", "i", "xty"), "xty", block), ["system", "b"])
    if prior is None:
        sides = sides.withColumn("p", F.transform("own", lambda x: F.lit(0.0)))
    else:
        sides = sides.join(row_blocks(prior.select("system", "i", "w"), "w", block).withColumnRenamed("w", "p"), ["system", "b"])
    widths = gram.groupBy("system").agg(F.max(F.size("xty")).alias("width"))
    cells = sides.join(widths, "system").select("system", "b", "width", F.posexplode(F.arrays_zip("w", "own", "p", "xty")).alias("k", "x"))
    left = F.col("x.w") + lam * F.col("x.own") - lam * F.col("x.p")
    place = (F.col("b") * block + F.floor(F.col("k") / F.col("width"))).cast("long")
    return cells.select("system", place.alias("i"), (F.col("k") % F.col("width")).cast("long").alias("j"), left.alias("left"), F.col("x.xty").alias("xty"))


def two_stage(gram1: DataFrame | None, gram2: DataFrame, lam: float = 1.0, mode: str = "two-stage", stage1: DataFrame | None = None,
              block: int = BLOCK, tol: float = TOL) -> dict[str, DataFrame]:
    """X5 flow on blocks: ``two-stage`` solves stage 1 (or reuses ``stage1``) and shrinks stage 2 towards it;
    ``single-stage`` solves stage 2 from zero."""
    if mode not in ("two-stage", "single-stage"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "single-stage":
        return {"stage2": solve(gram2, lam, block=block, tol=tol)}
    first = stage1 if stage1 is not None else solve(gram1, lam, block=block, tol=tol)
    return {"stage1": first, "stage2": solve(gram2, lam, first, block, tol)}
