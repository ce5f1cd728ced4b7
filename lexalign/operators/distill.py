"""Teacher-student distillation on DataFrames.

* ``label_with_teacher`` (X3): the teacher encodes the anchor side; the label is its vector.
* ``training_rows`` (U3): both text columns are trained towards the same label, so the
  training set is the union of the two projections.
* ``mse_eval`` (A10): ``-100 * mean((teacher - student)^2)`` over all cells, per group.
* ``translation_accuracy`` (A11): share of rows whose most cosine-similar counterpart is
  their own partner, both directions, and the mean of the two (exact 1-NN through the
  block-matmul miner; ties go to the smaller id, like ``argmax``).
* ``combined_score`` (A12): mean of the evaluators' main scores.
* ``linear_student`` (X5, a re-aim of fine-tuning): a ridge map from student-side
  features to teacher labels; its sufficient statistics ``X'X`` and ``X'Y`` are summed
  with ``Summarizer`` (partial aggregation, d rows per task), then the d x d system is
  solved on the driver.  Stage 2 shrinks towards the stage-1 weights.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexalign.functions.vectors import as_double, let, sq_dist
from lexalign.operators.knn import nearest_both


#: fixed value: the student whose name a run label leaves out
DEFAULT_STUDENT = "cis-lmu/glot500-base"


def run_label(mode, stage1_max, stage1_epochs, stage2_epochs, target_lang, student) -> Column:
    """The name of a run from its parameters (columns): mode, stage 1 size and epochs (two-stage only), stage 2 epochs,
    target language, and the student unless it is the default one (or null)."""
    mode, most, one, two, lang, student = (F.col(x) if isinstance(x, str) else x for x in (mode, stage1_max, stage1_epochs, stage2_epochs, target_lang, student))
    size = F.when(most > 0, F.concat(F.lit("cs"), F.floor(most / 1000).cast("string"), F.lit("k"))).otherwise("csAll")
    first = F.when(mode == "two-stage", F.concat_ws("_", size, F.concat(F.lit("s1e"), one.cast("string"))))
    other = F.when(student != DEFAULT_STUDENT, F.element_at(F.split(student, "/"), -1))
    return F.concat_ws("_", F.lit("distil"), mode, first, F.concat(F.lit("s2e"), two.cast("string")), lang, other)


def label_with_teacher(parallel: DataFrame, teacher: "callable", anchor_col: str = "english",
                       label_col: str = "label", keys=()) -> DataFrame:
    """``teacher`` maps a text column to a vector column (a Catalyst expression here).

    Rows are spread over all tasks first (``for_heavy_rows``): encoding is the costly step."""
    from lexalign.operators.util import for_heavy_rows

    return for_heavy_rows(parallel, *keys).withColumn(label_col, teacher(F.col(anchor_col)))


def training_rows(labelled: DataFrame, keys=(), cols=("english", "non_english"), label_col: str = "label"):
    """``(keys, text, label)`` — every text column paired with the row's label."""
    # one pass: a union of the columns would work the labels out once per column
    return labelled.select(*keys, F.explode(F.array(*[F.col(c) for c in cols])).alias("text"), label_col)


def mse_eval(pairs: DataFrame, keys, teacher_col: str = "teacher", student_col: str = "student") -> DataFrame:
    """A10: ``(keys, mse, negative_mse)`` with mse = 100 * mean squared cell difference."""
    keys = list(keys)
    agg = pairs.groupBy(*keys).agg(F.sum(sq_dist(teacher_col, student_col)).alias("_ss"),
                                   F.sum(F.size(teacher_col)).alias("_cells"))
    mse = F.col("_ss") / F.col("_cells") * F.lit(100.0)
    return agg.select(*keys, mse.alias("mse"), (-mse).alias("negative_mse"))


def translation_accuracy(src: DataFrame, tgt: DataFrame, keys, id_col: str = "sent_id", vec_col: str = "vec",
                         block_rows: int = 8192) -> DataFrame:
    """``(keys, src2trg, trg2src, accuracy)``; a row is a hit when its nearest
    counterpart (cosine) carries its own id."""
    keys = list(keys)
    near = nearest_both(src, tgt, keys, id_col=id_col, vec_col=vec_col, block_rows=block_rows)
    hits = near.groupBy(*keys, "side").agg(F.sum((F.col("id") == F.col("near")).cast("double")).alias("h"))
    rows = (src.select(*keys, F.lit("s").alias("side")).unionByName(tgt.select(*keys, F.lit("t").alias("side")))
            .groupBy(*keys, "side").agg(F.count(F.lit(1)).alias("n")))
    # a row without a similarity (zero vector) is a miss: it counts below but not above
    share = rows.join(hits, keys + ["side"], "left").select(*keys, "side", (F.coalesce("h", F.lit(0.0)) / F.col("n")).alias("a"))
    both = share.groupBy(*keys).agg(F.max(F.when(F.col("side") == "s", F.col("a"))).alias("src2trg"),
                                    F.max(F.when(F.col("side") == "t", F.col("a"))).alias("trg2src"))
    return both.where("src2trg is not null and trg2src is not null").select(
        *keys, "src2trg", "trg2src", ((F.col("src2trg") + F.col("trg2src")) / 2).alias("accuracy"))


def combined_score(mse: DataFrame, acc: DataFrame, keys) -> DataFrame:
    """Mean of the main scores (negative MSE, mean translation accuracy)."""
    keys = list(keys)
    return mse.join(acc, keys).select(*keys, "negative_mse", "accuracy",
                                      ((F.col("negative_mse") + F.col("accuracy")) / 2).alias("combined"))


def _gram_fn(keys, x_col, y_col):
    def run(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            pdf = pdf[pdf[x_col].notna() & pdf[y_col].notna()]
            if pdf.empty:
                continue
            groups = pdf.groupby(list(keys), sort=False) if keys else [((), pdf)]
            for key, g in groups:
                key = key if isinstance(key, tuple) else (key,)
                X = np.stack(g[x_col].to_numpy())
                Y = np.stack(g[y_col].to_numpy())
                xtx, xty = X.T @ X, X.T @ Y
                rows = {k: [v] * X.shape[1] for k, v in zip(keys, key)}
                rows.update(i=np.arange(X.shape[1], dtype=np.int32), xtx=list(xtx), xty=list(xty),
                            n=np.full(X.shape[1], len(g), dtype=np.int64))
                yield pd.DataFrame(rows)
    return run


def gram_statistics(rows: DataFrame, x_col: str, y_col: str, keys=()) -> DataFrame:
    """X5 sufficient statistics: ``(keys, i, xtx array, xty array, n)`` — row ``i`` of
    ``X'X`` and ``X'Y``.  Every Arrow batch contributes its own ``X'X`` and ``X'Y`` (numpy),
    i.e. ``d`` partial rows, which a partial aggregate (``Summarizer.sum``) merges; no task
    ships its data, only ``d`` rows per batch."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    keys = list(keys)
    inp = rows.select(*keys, as_double(x_col).alias("_x"), as_double(y_col).alias("_y"))
    key_schema = ", ".join(f"`{k}` {inp.schema[k].dataType.simpleString()}" for k in keys)
    schema = (key_schema + ", " if keys else "") + "i int, xtx array<double>, xty array<double>, n long"
    part = inp.mapInPandas(_gram_fn(keys, "_x", "_y"), schema)
    return (part.groupBy(*keys, "i")
            .agg(Summarizer.sum(array_to_vector("xtx")).alias("_a"), Summarizer.sum(array_to_vector("xty")).alias("_b"),
                 F.sum("n").alias("n"))
            .select(*keys, "i", vector_to_array("_a").alias("xtx"), vector_to_array("_b").alias("xty"), "n"))


def solve_ridge(gram: DataFrame, lam: float = 1.0, prior: np.ndarray | None = None) -> np.ndarray:
    """Solve ``(X'X + lam I) W = X'Y + lam * prior`` (d x d; prior 0 = plain ridge).

    Only the d x d statistics reach the driver."""
    rows = sorted(gram.select("i", "xtx", "xty").collect(), key=lambda r: r["i"])
    if not rows:
        raise ValueError("no training rows")
    d = len(rows[0]["xtx"])
    G = np.array([r["xtx"] for r in rows], dtype=np.float64)
    B = np.array([r["xty"] for r in rows], dtype=np.float64)
    P = np.zeros((d, B.shape[1])) if prior is None else prior
    return np.linalg.solve(G + lam * np.eye(d), B + lam * P)


def apply_linear(df: DataFrame, W: np.ndarray, x_col: str, out_col: str) -> DataFrame:
    """Student prediction ``x W`` as a Catalyst expression (W is d x d, a parameter)."""
    wt = [[float(v) for v in col] for col in W.T]  # one column of W per output element
    cols = F.array(*[F.array(*[F.lit(v) for v in c]) for c in wt])
    return df.withColumn(out_col, let(as_double(x_col), lambda x: F.transform(cols, lambda c: F.aggregate(
        F.zip_with(x, c, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v))))


def two_stage(stage1: DataFrame | None, stage2: DataFrame, x_col: str, y_col: str, lam: float = 1.0,
              mode: str = "two-stage", stage1_weights: np.ndarray | None = None) -> dict:
    """X5 flow: ``two-stage`` fits stage 1 (or reuses ``stage1_weights``) then stage 2 shrunk
    towards it; ``single-stage`` fits stage 2 from zero."""
    if mode not in ("two-stage", "single-stage"):
        raise ValueError(f"unknown mode {mode!r}")
    out = {}
    prior = None
    if mode == "two-stage":
        prior = stage1_weights if stage1_weights is not None else solve_ridge(
            gram_statistics(stage1, x_col, y_col), lam)
        out["stage1"] = prior
    out["stage2"] = solve_ridge(gram_statistics(stage2, x_col, y_col), lam, prior)
    return out
