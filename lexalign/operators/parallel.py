"""Parallel corpus preparation.

* Lines are stripped like Python ``str.strip`` (all Unicode whitespace and U+001C..U+001F).
* ``with_ordinal``: global line number of every kept line in ``(doc, position)`` order,
  computed with two-level prefix sums (bucket totals, then offsets inside a bucket); no
  window ever spans the whole table.
* ``parallel_from_documents``: inner equi-join on the ordinal, so the result has the length of
  the shorter side.  ``drop_blank='independent'`` drops blank lines on each side before
  numbering (the reference's behaviour: one stray blank shifts every later pair);
  ``'pairwise'`` numbers raw lines and drops a pair if either side is blank.
* ``train_eval_split``: ``eval_size = min(1000, int(0.1 * n))`` rows with the smallest
  ``md5(seed:pair:ord)`` form the evaluation part; a top-N with a map-side group limit,
  never a global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexalign.functions.text import strip_unicode

DROP_MODES = ("independent", "pairwise")
EVAL_CAP = 1000
EVAL_SHARE = 0.1
SEED = 42
RUN = 4096


def _doc_lines(docs: DataFrame, text_col: str, drop_blank: bool) -> Column:
    stripped = F.transform(F.split(F.col(text_col), "\n"), lambda x: strip_unicode(x))
    return F.filter(stripped, lambda x: x != "") if drop_blank else stripped


def with_ordinal(units: DataFrame, part_cols, order_col: str, count_col: str, out_col: str = "offset", tie: str | None = None) -> DataFrame:
    """W7 core: exclusive prefix sum of ``count_col`` in ``order_col`` order within ``part_cols``.

    ``order_col`` holds integers that were handed out in order (line numbers, document ids).  Units fall into runs of
    ``RUN`` numbers and runs into runs of runs; each level's prefix sums come from a window over one run, so no window
    holds more than ``RUN`` rows below the last level, and that one has a row per ``RUN * RUN`` numbers.  The plan is
    lazy: no quantiles, no collect.

    Rows without an order key come last, as runs of their own (dealt by ``tie``).  Rows that repeat a key follow each other
    by ``tie`` (a column that tells them apart); without one their order is not fixed.
    """
    part_cols = list(part_cols)

    def before(partition, order, value):
        w = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(w), F.lit(0))

    def meet(left, right, on):
        """Equi-join that takes a null key for a key."""
        names = {c: f"_k{i}" for i, c in enumerate(on)}
        right = right.withColumnsRenamed(names)
        same = [F.col(c).eqNullSafe(F.col(k)) for c, k in names.items()]
        return left.join(right, same).drop(*names.values())

    def run(col, size):
        return F.floor(F.col(col).cast("long") / F.lit(size))

    if tie is not None:
        units = units.withColumn("_tie", F.xxhash64(tie)).withColumn("_more", F.col(tie))
    # null keys take runs above all others; a hash of the tie deals them out
    top = F.lit((1 << 52) // RUN)
    spare = top + (F.pmod(F.col("_tie"), F.lit(RUN)) if tie is not None else F.lit(0))
    b = units.withColumn("_r1", F.coalesce(run(order_col, RUN), spare))
    t1 = b.groupBy(*part_cols, "_r1").agg(F.sum(count_col).alias("_t1")).withColumn("_r2", run("_r1", RUN))
    t2 = t1.groupBy(*part_cols, "_r2").agg(F.sum("_t1").alias("_t2"))
    t2 = t2.withColumn("_o2", before(part_cols, "_r2", "_t2")).drop("_t2")
    t1 = t1.withColumn("_o1", before([*part_cols, "_r2"], "_r1", "_t1")).drop("_t1")
    offsets = meet(t1, t2, part_cols + ["_r2"]).select(*part_cols, "_r1", (F.col("_o1") + F.col("_o2")).alias("_before"))
    own = [F.col(order_col)] + ([F.col("_tie"), F.col("_more")] if tie is not None else [])
    w = Window.partitionBy(*part_cols, "_r1").orderBy(*own).rowsBetween(Window.unboundedPreceding, -1)
    inner = b.withColumn("_own", F.coalesce(F.sum(count_col).over(w), F.lit(0)))
    return (meet(inner, offsets, part_cols + ["_r1"]).withColumn(out_col, (F.col("_before") + F.col("_own")).cast("long"))
            .drop("_r1", "_before", "_own", "_tie", "_more"))


def numbered_lines(docs: DataFrame, side_col: str = "lang", doc_col: str = "doc_id", text_col: str = "text",
                   drop_blank: bool = True) -> DataFrame:
    """``(side, ord, line)``: every line of every document, numbered across documents in
    ``(doc_id, position)`` order within each side.  Blank lines are dropped before numbering
    when ``drop_blank``; otherwise they are kept (and numbered) as empty strings."""
    per_doc = docs.select(F.col(side_col).alias("side"), F.col(doc_col).alias("doc"),
                          _doc_lines(docs, text_col, drop_blank).alias("lines"))
    per_doc = per_doc.withColumn("n", F.size("lines").cast("long"))
    off = with_ordinal(per_doc, ["side"], "doc", "n", tie="lines")
    pos_line = F.transform("lines", lambda x, i: F.struct(i.alias("pos"), x.alias("line")))
    return (off.select("side", "offset", F.inline(pos_line))
            .select("side", (F.col("offset") + F.col("pos")).alias("ord"), "line"))


def cap(df: DataFrame, n: int | None, ord_col: str = "ord") -> DataFrame:
    """L1: keep the first ``n`` pairs; ``None`` or 0 keeps all."""
    return df if not n else df.where(F.col(ord_col) < n)


def parallel_from_documents(docs: DataFrame, anchor_lang: str, other_langs=None, drop_blank: str = "independent",
                            max_sentences: int | None = None) -> DataFrame:
    """S7 over a document table: ``(pair, ord, english, non_english)`` for every other language
    (``other_langs``: only these)."""
    if drop_blank not in DROP_MODES:
        raise ValueError(f"unknown drop_blank mode {drop_blank!r}; expected one of {DROP_MODES}")
    wanted = F.col("lang").isNotNull() if other_langs is None else F.col("lang").isin([anchor_lang, *other_langs])
    lines = numbered_lines(docs.where(wanted), drop_blank=(drop_blank == "independent"))
    anchor = lines.where(F.col("side") == anchor_lang)
    other = lines.where(F.col("side") != anchor_lang)
    z = (anchor.select("ord", F.col("line").alias("english"))
         .join(other.select(F.col("side"), "ord", F.col("line").alias("non_english")), "ord")
         .select(F.concat_ws("-", F.col("side"), F.lit(anchor_lang)).alias("pair"), "ord", "english",
                 "non_english"))
    if drop_blank == "pairwise":
        z = z.where((F.col("english") != "") & (F.col("non_english") != ""))
        # renumber kept pairs so ordinals stay dense
        z = with_ordinal(z.withColumn("_one", F.lit(1)), ["pair"], "ord", "_one", "_new").drop("ord", "_one") \
            .withColumnRenamed("_new", "ord")
    return cap(z, max_sentences).select("pair", "ord", "english", "non_english")


def pair_sizes(docs: DataFrame, anchor_lang: str, max_sentences: int | None = None) -> DataFrame:
    """``(pair, n)`` of ``parallel_from_documents(drop_blank='independent')``: a zip is as long as its shorter side, so the
    line counts of the documents tell it without moving a text."""
    lines = docs.where(F.col("lang").isNotNull()).select("lang", F.size(_doc_lines(docs, "text", True)).cast("long").alias("n"))
    sides = lines.groupBy("lang").agg(F.sum("n").alias("n"))
    anchor = sides.where(F.col("lang") == anchor_lang).select(F.lit(anchor_lang).alias("a"), F.col("n").alias("most"))
    z = sides.where(F.col("lang") != anchor_lang).withColumn("a", F.lit(anchor_lang)).join(anchor, "a")
    n = F.least("n", "most", *([F.lit(max_sentences)] if max_sentences else []))
    return z.select(F.concat_ws("-", "lang", "a").alias("pair"), n.alias("n")).where("n > 0")


def _drawn(sizes: DataFrame, part_col: str, seed: int) -> DataFrame:
    """``(part_col, ord, _h)`` of every ordinal below the pair's size, from the sizes alone."""
    n = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = sizes.select(part_col, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))).alias("_from"))
    upto = F.least(F.col("_from") + RUN, F.col("n")) - 1
    ords = runs.repartition(n).select(part_col, F.explode(F.sequence("_from", upto)).alias("ord"))
    return ords.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(part_col), F.col("ord").cast("string"))))


def train_eval_split(parallel: DataFrame, seed: int = SEED, cap_n: int = EVAL_CAP, share: float = EVAL_SHARE,
                     part_col: str = "pair", sizes: DataFrame | None = None) -> DataFrame:
    """Adds ``part`` ('train' | 'eval').  ``eval_size = min(cap_n, int(share * n))`` per pair.

    With ``sizes`` (``part_col, n``; ordinals must then run from 0 to ``n - 1``) the evaluation ordinals are drawn from
    them, and ``parallel`` is read once; without, its ordinals and sizes are read from it first."""
    if sizes is None:
        h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(part_col), F.col("ord").cast("string")))
        drawn = parallel.select(part_col, "ord", h.alias("_h"))
        sizes = parallel.groupBy(part_col).agg(F.count(F.lit(1)).alias("n"))
    else:
        drawn = _drawn(sizes, part_col, seed)
    w = Window.partitionBy(part_col).orderBy("_h", "ord")
    top = drawn.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap_n)
    evals = sizes.select(part_col, F.least(F.lit(cap_n), F.floor(F.col("n") * F.lit(share))).cast("long").alias("_eval"))
    ev = (top.join(evals, part_col).where(F.col("_rn") <= F.col("_eval"))
          .select(part_col, "ord", F.lit("eval").alias("part")))
    return parallel.join(ev, [part_col, "ord"], "left").withColumn("part", F.coalesce(F.col("part"), F.lit("train")))


def corpus_report(split_df: DataFrame, part_col: str = "pair") -> DataFrame:
    """Loaded / train / eval counts per pair."""
    return split_df.groupBy(part_col).agg(
        F.count(F.lit(1)).alias("loaded"),
        F.sum((F.col("part") == "train").cast("long")).alias("train"),
        F.sum((F.col("part") == "eval").cast("long")).alias("eval"))
