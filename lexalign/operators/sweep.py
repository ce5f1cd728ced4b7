"""Threshold sweep, best threshold, transfer analysis.

One pass instead of one scan per threshold: thresholds are monotone (``std >= 0``), so
the set of grid values a candidate passes is a prefix of the grid.  Each candidate
gets ``passed`` = how many grid values it passes; a partial aggregation by
``(group, passed)`` leaves at most ``len(grid) + 1`` rows per group and task, and a
reverse running sum over the dense grid turns them into predicted/tp counts for every
threshold.  The sweep filters with the accumulated float (``raw``) and reports the
rounded value (``threshold``); prediction files are cut with the rounded value, as the
reference does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexalign.functions.grid import grid_literal, threshold_grid
from lexalign.operators.evaluate import (GOLD_KEYS, apply_filter, check_method, f1_of,
                                         gold_last_wins, gold_sizes, mark_hits, passes, prf, score_stats)

KEYS = ("lang_pair", "model", "split")
PAIR_KEYS = ("lang_pair", "model")
SWEEP_COLUMNS = ["lang_pair", "model", "split", "threshold", "precision", "recall", "f1"]
SUMMARY_COLUMNS = ["lang_pair", "model", "train_best_th", "train_best_f1", "train_best_p", "train_best_r",
                   "test_best_th", "test_best_f1", "test_best_p", "test_best_r",
                   "test_f1_at_train_th", "test_p_at_train_th", "test_r_at_train_th", "transfer_gap"]


def sweep(cands: DataFrame, gold: DataFrame, method: str = "dynamic", grid=None, keys=KEYS,
          groups: DataFrame | None = None, gold_keys=GOLD_KEYS) -> DataFrame:
    """A4: P/R/F1 at every grid threshold for every group.

    ``cands``: ``(keys, src_id, tgt_id, score)``; ``gold``: ``(gold_keys, line_no, src_id, tgt_id)``.
    ``groups``: groups to report (both inputs present); defaults to the candidate groups.
    Returns ``(keys, idx, raw, threshold, predicted, tp, gold_n, precision, recall, f1)``.
    """
    check_method(method)
    keys = list(keys)
    grid = grid or threshold_grid()
    g = grid_literal(grid)
    if method == "dynamic":
        rows = cands.join(score_stats(cands, keys), keys)
        passed = F.size(F.filter(g, lambda e: passes(F.col("score"), F.col("mu") + e["raw"] * F.col("sd"))))
    else:
        rows = cands
        passed = F.size(F.filter(g, lambda e: passes(F.col("score"), e["raw"])))
    gc = gold_last_wins(gold, gold_keys)
    counts = (mark_hits(rows.select(*keys, "src_id", "tgt_id", "score", *(["mu", "sd"] if method == "dynamic" else [])),
                        gc, gold_keys)
              .withColumn("passed", passed)
              .where(F.col("passed") > 0)
              .groupBy(*keys, "passed").agg(F.count(F.lit(1)).alias("c"), F.sum("hit").alias("h")))
    if groups is None:
        groups = cands.select(*keys).distinct()
    dense = groups.select(*keys, F.explode(g).alias("g")).select(
        *keys, F.col("g.idx").alias("idx"), F.col("g.raw").alias("raw"), F.col("g.th").alias("threshold"))
    w = Window.partitionBy(*keys).orderBy(F.col("idx").desc()).rowsBetween(Window.unboundedPreceding,
                                                                            Window.currentRow)
    out = (dense.join(counts.withColumn("idx", F.col("passed") - 1).drop("passed"), keys + ["idx"], "left")
           .withColumn("predicted", F.sum(F.coalesce("c", F.lit(0))).over(w))
           .withColumn("tp", F.sum(F.coalesce("h", F.lit(0))).over(w))
           .drop("c", "h")
           .join(gold_sizes(gc, gold_keys), list(gold_keys), "left")
           .withColumn("gold_n", F.coalesce("gold_n", F.lit(0))))
    p, r = prf(F.col("tp"), F.col("predicted"), F.col("gold_n"))
    out = out.withColumn("precision", p).withColumn("recall", r)
    return out.withColumn("f1", f1_of(F.col("precision"), F.col("recall"))).select(
        *keys, "idx", "raw", "threshold", "predicted", "tp", "gold_n", "precision", "recall", "f1")


def best_threshold(sweep_df: DataFrame, keys=KEYS) -> DataFrame:
    """The row of highest F1 per group; the first (lowest) threshold wins ties."""
    keys = list(keys)
    best = F.max_by(F.struct("idx", "raw", "threshold", "precision", "recall", "f1"),
                    F.struct(F.col("f1"), -F.col("idx")))
    return sweep_df.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def best_predictions(cands: DataFrame, sweep_df: DataFrame, method: str = "dynamic", keys=KEYS) -> DataFrame:
    """Every group's candidates cut at that group's best (reported) threshold."""
    keys = list(keys)
    best = best_threshold(sweep_df, keys).select(*keys, F.col("threshold").alias("best_th"))
    kept = apply_filter(cands.join(best, keys), F.col("best_th"), method, keys)
    return kept.select(*keys, "src_id", "tgt_id")


def transfer_predictions(cands: DataFrame, sweep_df: DataFrame, method: str = "dynamic",
                         pair_keys=PAIR_KEYS, train="train", test="test") -> DataFrame:
    """Test candidates cut at the train-best threshold (test statistics apply)."""
    pair_keys = list(pair_keys)
    keys = pair_keys + ["split"]
    tb = best_threshold(sweep_df.where(F.col("split") == train), keys).select(
        *pair_keys, F.col("threshold").alias("train_th"))
    test_c = cands.where(F.col("split") == test).join(tb, pair_keys)
    kept = apply_filter(test_c, F.col("train_th"), method, keys)
    return kept.select(*keys, "src_id", "tgt_id")


def transfer_summary(sweep_df: DataFrame, pair_keys=PAIR_KEYS, train="train", test="test") -> DataFrame:
    """J7 + J8: one row per (lang_pair, model) that has a train sweep.

    Test columns stay null without a test sweep.  ``test_*_at_train_th`` come from the
    test row whose threshold is nearest the train-best one (first on exact ties), and
    ``transfer_gap = test_best_f1 - test_f1_at_train_th``.  ``at_grid_edge`` flags a
    train-best threshold on the first or last grid value.
    """
    pair_keys = list(pair_keys)
    keys = pair_keys + ["split"]
    bt = best_threshold(sweep_df.where(F.col("split").isin(train, test)), keys)
    tr = bt.where(F.col("split") == train).select(
        *pair_keys, F.col("threshold").alias("train_best_th"), F.col("f1").alias("train_best_f1"),
        F.col("precision").alias("train_best_p"), F.col("recall").alias("train_best_r"),
        F.col("idx").alias("train_best_idx"))
    te = bt.where(F.col("split") == test).select(
        *pair_keys, F.col("threshold").alias("test_best_th"), F.col("f1").alias("test_best_f1"),
        F.col("precision").alias("test_best_p"), F.col("recall").alias("test_best_r"))
    test_rows = sweep_df.where(F.col("split") == test).select(*pair_keys, "idx", "threshold", "precision", "recall",
                                                              "f1")
    near = (test_rows.join(tr.select(*pair_keys, "train_best_th"), pair_keys)
            .groupBy(*pair_keys)
            .agg(F.min_by(F.struct("f1", "precision", "recall"),
                          F.struct(F.abs(F.col("threshold") - F.col("train_best_th")), F.col("idx"))).alias("n"))
            .select(*pair_keys, F.col("n.f1").alias("test_f1_at_train_th"),
                    F.col("n.precision").alias("test_p_at_train_th"), F.col("n.recall").alias("test_r_at_train_th")))
    edges = sweep_df.groupBy(*pair_keys).agg(F.max("idx").alias("max_idx"))
    out = (tr.join(te, pair_keys, "left").join(near, pair_keys, "left").join(edges, pair_keys, "left")
           .withColumn("transfer_gap", F.col("test_best_f1") - F.col("test_f1_at_train_th"))
           .withColumn("at_grid_edge", (F.col("train_best_idx") == 0) | (F.col("train_best_idx") == F.col("max_idx"))))
    return out.select(*SUMMARY_COLUMNS, "at_grid_edge")


def leaderboard(summary: DataFrame, model_order=None, pair_order=None) -> DataFrame:
    """L2: summary ranked by test-best F1 descending (missing = 0), stable in config order.

    The summary has one row per (lang_pair, model), a size fixed by the work list, so
    a single ordered window over it is cheap.
    """
    order = [F.coalesce(F.col("test_best_f1"), F.lit(0.0)).desc()]
    if model_order:
        order.append(F.array_position(F.array(*[F.lit(m) for m in model_order]), F.col("model")))
    else:
        order.append(F.col("model"))
    if pair_order:
        order.append(F.array_position(F.array(*[F.lit(p) for p in pair_order]), F.col("lang_pair")))
    else:
        order.append(F.col("lang_pair"))
    return summary.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
