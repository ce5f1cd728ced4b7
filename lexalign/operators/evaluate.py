"""Threshold filters, score statistics and gold evaluation (P5, P6, A2, S3 rule, J6, A3).

Semantics pinned by the reference's filter and scorer:

* a candidate passes a threshold iff ``score > cut`` (strict); a NaN score never passes
  (Spark orders NaN above every number, so the NaN test is explicit);
* ``dynamic``: ``cut = mean + t * std`` with the *population* std of all scores of the
  group (a group of one has std 0; a NaN score makes the mean NaN and nothing passes);
* gold: one target per source, the last line wins; the gold size counts distinct sources;
* every prediction counts, duplicates included: ``tp`` = predictions whose source is in
  gold with the same target, ``fp`` = the rest, ``fn = |gold| - tp``;
* ``P = tp/(tp+fp)``, ``R = tp/(tp+fn)``, ``F1 = 2PR/(P+R)``, each 0 when its denominator is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


FILTER_METHODS = ("dynamic", "static")
GOLD_KEYS = ("lang_pair", "split")


def check_method(method: str) -> str:
    if method not in FILTER_METHODS:
        raise ValueError(f"unknown filter method {method!r}; expected one of {FILTER_METHODS}")
    return method


def score_stats(cands: DataFrame, keys) -> DataFrame:
    """A2: ``(keys, mu, sd, n_cands)`` with the population standard deviation."""
    return cands.groupBy(*keys).agg(F.avg("score").alias("mu"), F.stddev_pop("score").alias("sd"),
                                    F.count(F.lit(1)).alias("n_cands"))


def passes(score: Column, cut: Column) -> Column:
    return (score > cut) & ~F.isnan(score) & ~F.isnan(cut)


def filter_static(cands: DataFrame, threshold) -> DataFrame:
    """P5: keep ``score > threshold``.  ``threshold`` may be a number or a column."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return cands.where(passes(F.col("score"), t))


def with_stats(cands: DataFrame, keys) -> DataFrame:
    return cands.join(score_stats(cands, keys), list(keys))


def filter_dynamic(cands: DataFrame, threshold, keys) -> DataFrame:
    """Keep ``score > mean + threshold * std`` per group (population std)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return with_stats(cands, keys).where(passes(F.col("score"), F.col("mu") + t * F.col("sd")))


def apply_filter(cands: DataFrame, threshold, method: str, keys) -> DataFrame:
    check_method(method)
    if method == "dynamic":
        return filter_dynamic(cands, threshold, keys).drop("mu", "sd", "n_cands")
    return filter_static(cands, threshold)


def gold_last_wins(gold: DataFrame, keys=GOLD_KEYS) -> DataFrame:
    """S3: one target per (keys, src_id): the target of the highest line number."""
    return gold.groupBy(*keys, "src_id").agg(F.max_by("tgt_id", "line_no").alias("gold_tgt"))


def gold_sizes(gold_clean: DataFrame, keys=GOLD_KEYS) -> DataFrame:
    return gold_clean.groupBy(*keys).agg(F.count(F.lit(1)).alias("gold_n"))


def mark_hits(preds: DataFrame, gold_clean: DataFrame, gold_keys=GOLD_KEYS) -> DataFrame:
    """``hit`` = 1 iff the source is in gold with the same target (shuffle on source id)."""
    g = gold_clean.select(*gold_keys, "src_id", "gold_tgt")
    return (preds.join(g, list(gold_keys) + ["src_id"], "left")
            .withColumn("hit", F.coalesce((F.col("tgt_id") == F.col("gold_tgt")).cast("int"), F.lit(0)))
            .drop("gold_tgt"))


def prf(tp: Column, predicted: Column, gold_n: Column):
    """Precision, recall, F1 with the reference's zero guards."""
    p = F.when(predicted > 0, tp / predicted).otherwise(F.lit(0.0))
    r = F.when(gold_n > 0, tp / gold_n).otherwise(F.lit(0.0))
    return p, r


def f1_of(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))


def evaluate(preds: DataFrame, gold: DataFrame, keys, groups: DataFrame | None = None,
             gold_keys=GOLD_KEYS) -> DataFrame:
    """A3: ``(keys, predicted, tp, gold_n, precision, recall, f1)`` per group.

    ``gold`` has ``(gold_keys, line_no, src_id, tgt_id)``; ``groups`` lists the groups to
    report (defaults to the groups present in ``preds``), so an empty prediction set still
    yields a zero row.
    """
    keys = list(keys)
    gc = gold_last_wins(gold, gold_keys)
    counts = (mark_hits(preds, gc, gold_keys).groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("predicted"), F.sum("hit").alias("tp")))
    if groups is None:
        groups = preds.select(*keys).distinct()
    out = (groups.join(counts, keys, "left")
           .join(gold_sizes(gc, gold_keys), list(gold_keys), "left")
           .select(*keys, F.coalesce("predicted", F.lit(0)).alias("predicted"),
                   F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("gold_n", F.lit(0)).alias("gold_n")))
    p, r = prf(F.col("tp"), F.col("predicted"), F.col("gold_n"))
    out = out.withColumn("precision", p).withColumn("recall", r)
    return out.withColumn("f1", f1_of(F.col("precision"), F.col("recall")))
