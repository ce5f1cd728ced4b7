"""Readers for the mining pipeline's text formats (S1, S3-S7) with explicit schemas.

All readers go through ``read_lines``, which numbers the lines of every file in file
order without a global window: a text scan keeps each file split (block) in one task,
in order, so ``line_no = (lines in earlier blocks of the file) + (row offset inside
the block)``.  The per-block counts are a small table (one row per block).

Formats (fixed by the pipeline):

* sentences ``{pair}.{split}.{lang}``: ``ID<TAB>sentence``, exactly two fields
* gold ``{pair}.{split}.gold``: ``src<TAB>tgt``, exactly two fields, last line per src wins
* candidates ``.sim``: ``src<TAB>tgt<TAB>score[<TAB>...]``, score parsed like Python ``float``
* predictions ``.pred.*``: ``src<TAB>tgt``, duplicates kept
* vectors ``.vec``: header ``n dim``, then ``id v1 ... vdim``; blank lines ignored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


ON_BAD = ("fail", "quarantine")

# Python float() accepts these forms (underscores between digits, nan/inf words);
# anything else (e.g. "0.5d", which a SQL cast would take) is rejected.
FLOAT_PATTERN = (r"^\s*[+-]?(((\d(_?\d)*)(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?"
                 r"|(?i:nan|inf|infinity))\s*$")


def read_lines(spark: SparkSession, path, per_directory: bool = False) -> DataFrame:
    """``(file string, line_no long, value string)`` for every line of the text files at ``path``.

    With ``per_directory`` the part files of one directory (a Spark text export) form one
    logical file, in part-file name order; ``file`` is then the directory."""
    raw = spark.read.format("text").load(path)
    fpath = F.col("_metadata.file_path")
    unit = F.regexp_replace(fpath, "/[^/]*$", "") if per_directory else fpath
    raw = raw.select(unit.alias("file"), fpath.alias("_path"), F.col("_metadata.file_block_start").alias("blk"),
                     F.monotonically_increasing_id().alias("_mid"), "value")
    blocks = raw.groupBy("file", "_path", "blk").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("file").orderBy("_path", "blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    return (raw.join(blocks, ["file", "_path", "blk"])
            .select("file", (F.col("_off") + F.col("_mid") - F.col("_first")).alias("line_no"), "value"))


def _name_parts(file_col: Column) -> Column:
    return F.split(F.element_at(F.split(file_col, "/"), -1), r"\.")


def _key(name: str, place: int) -> Column:
    """A group key: from a ``name=value`` directory of our own exports, else from that part of the file name."""
    own = F.regexp_extract(F.col("file"), f"/{name}=([^/]+)(?:/|$)", 1)
    return F.when(own != "", own).otherwise(F.try_element_at(F.col("_n"), F.lit(place))).alias(name)


def _fail_or_flag(df: DataFrame, ok: Column, on_bad: str, what: str) -> DataFrame:
    if on_bad not in ON_BAD:
        raise ValueError(f"unknown on_bad {on_bad!r}; expected one of {ON_BAD}")
    if on_bad == "fail":
        msg = F.concat(F.lit(f"malformed {what} line "), F.col("line_no").cast("string"), F.lit(" in "),
                       F.col("file"))
        # a filter predicate is always evaluated (an unused column would be pruned)
        return df.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(msg)))
    return df.withColumn("bad", ~ok)


def read_sentences(spark: SparkSession, path, on_bad: str = "fail") -> DataFrame:
    """``(lang_pair, split, lang, line_no, sent_id, text)``.  A line without exactly two
    tab-separated fields fails the read (or, with ``on_bad='quarantine'``, is flagged ``bad``)."""
    return parse_sentences(read_lines(spark, path), on_bad)


def parse_sentences(lines: DataFrame, on_bad: str = "fail") -> DataFrame:
    """S1 over ``(file, line_no, value)`` lines; a missing field is null."""
    parts = F.split("value", "\t")
    df = lines.withColumn("_p", parts).withColumn("_n", _name_parts(F.col("file")))
    df = _fail_or_flag(df, F.size("_p") == 2, on_bad, "sentence")
    cols = [_key("lang_pair", 1), _key("split", 2),
            _key("lang", 3), "line_no",
            F.try_element_at("_p", F.lit(1)).alias("sent_id"), F.try_element_at("_p", F.lit(2)).alias("text")]
    if on_bad == "quarantine":
        cols.append("bad")
    return df.select(*cols)


def parse_pairs(lines: DataFrame, what: str = "gold", a: str = "src_id", b: str = "tgt_id", on_bad: str = "fail") -> DataFrame:
    """S3, S5 over ``(file, line_no, value)`` lines of two fields."""
    df = lines.withColumn("_p", F.split("value", "\t")).withColumn("_n", _name_parts(F.col("file")))
    df = _fail_or_flag(df, F.size("_p") == 2, on_bad, what)
    cols = [_key("lang_pair", 1), _key("split", 2), "file", "line_no",
            F.try_element_at("_p", F.lit(1)).alias(a), F.try_element_at("_p", F.lit(2)).alias(b)]
    if on_bad == "quarantine":
        cols.append("bad")
    return df.select(*cols)


def read_gold(spark: SparkSession, path, on_bad: str = "fail") -> DataFrame:
    """S3: ``(lang_pair, split, file, line_no, src_id, tgt_id)``; resolve duplicates with
    ``gold_last_wins``."""
    return parse_pairs(read_lines(spark, path), "gold", on_bad=on_bad)


def read_predictions(spark: SparkSession, path, on_bad: str = "fail") -> DataFrame:
    """``(lang_pair, split, file, line_no, src_id, tgt_id)``, duplicates kept."""
    return parse_pairs(read_lines(spark, path), "prediction", on_bad=on_bad)


def parse_float(s: Column) -> Column:
    """Python ``float`` parsing: null when the text is not a float literal."""
    clean = F.regexp_replace(F.trim(s), "_", "")
    return F.when(s.rlike(FLOAT_PATTERN), clean.try_cast("double"))


def read_candidates(spark: SparkSession, path, on_bad: str = "fail") -> DataFrame:
    """``(lang_pair, split, model, file, line_no, src_id, tgt_id, score)``: columns 0-2 of
    each line, extra columns ignored; a score Python's ``float`` would reject fails the read.
    Group keys come from ``name=value`` directories, else from a ``{pair}.{split}.{model}.sim`` file name."""
    return parse_candidates(read_lines(spark, path), on_bad)


def parse_candidates(lines: DataFrame, on_bad: str = "fail") -> DataFrame:
    """S4 over ``(file, line_no, value)`` lines."""
    p = F.split("value", "\t")
    df = (lines.withColumn("_p", p).withColumn("_n", _name_parts(F.col("file")))
          .withColumn("score", parse_float(F.try_element_at("_p", F.lit(3)))))
    ok = (F.size("_p") >= 3) & F.col("score").isNotNull()
    df = _fail_or_flag(df, ok, on_bad, "candidate")
    cols = [_key("lang_pair", 1), _key("split", 2),
            _key("model", 3), "file", "line_no",
            F.try_element_at("_p", F.lit(1)).alias("src_id"), F.try_element_at("_p", F.lit(2)).alias("tgt_id"), "score"]
    if on_bad == "quarantine":
        cols.append("bad")
    return df.select(*cols)


def read_vec(spark: SparkSession, path, per_directory: bool = False) -> DataFrame:
    """``(lang_pair, split, lang, model, file, line_no, sent_id, vec array<float>)``; the header line and blank lines are
    skipped.  ``per_directory`` reads a ``write_vec`` export (ordered part files) as one file."""
    return parse_vec(read_lines(spark, path, per_directory))


def parse_vec(lines: DataFrame) -> DataFrame:
    """S6 over ``(file, line_no, value)`` lines."""
    body = lines.where((F.col("line_no") > 0) & (F.trim("value") != ""))
    p = F.split(F.trim("value"), " ")
    body = body.withColumn("_n", _name_parts(F.col("file")))
    return body.select(_key("lang_pair", 1), _key("split", 2), _key("lang", 3), _key("model", 4), "file", "line_no",
                       F.element_at(p, 1).alias("sent_id"),
                       F.slice(p, 2, F.size(p) - 1).cast("array<float>").alias("vec"))


def vec_header_check(spark: SparkSession, path) -> DataFrame:
    """Q4 report: ``(file, header_n, header_dim, rows, dim, n_matches)`` — a header count that
    differs from the rows (skipped sentences) is a warning, not an error."""
    lines = read_lines(spark, path)
    head = lines.where(F.col("line_no") == 0).select(
        "file", F.split(F.trim("value"), " ").alias("h")).select(
        "file", F.element_at("h", 1).cast("long").alias("header_n"), F.element_at("h", 2).cast("int").alias("header_dim"))
    body = read_vec(spark, path).groupBy("file").agg(F.count(F.lit(1)).alias("rows"),
                                                     F.max(F.size("vec")).alias("dim"))
    return head.join(body, "file", "left").withColumn("n_matches", F.col("header_n") == F.col("rows"))


def read_parallel_files(spark: SparkSession, other_path: str, anchor_path: str, drop_blank: str = "independent",
                        max_sentences: int | None = None) -> DataFrame:
    """Two line-aligned files -> ``(ord, english, non_english)``; the anchor file is the
    teacher's language."""
    from lexalign.functions.text import strip_unicode
    from lexalign.operators.parallel import DROP_MODES, cap, with_ordinal

    if drop_blank not in DROP_MODES:
        raise ValueError(f"unknown drop_blank mode {drop_blank!r}; expected one of {DROP_MODES}")

    def side(path):
        li = read_lines(spark, path).select("line_no", strip_unicode(F.col("value")).alias("line"))
        if drop_blank == "independent":
            li = li.where(F.col("line") != "")
            li = with_ordinal(li.withColumn("_one", F.lit(1)).withColumn("_p", F.lit(0)), ["_p"], "line_no", "_one",
                              "ord").drop("_one", "_p")
        else:
            li = li.withColumnRenamed("line_no", "ord")
        return li.select("ord", "line")

    z = side(anchor_path).select("ord", F.col("line").alias("english")).join(
        side(other_path).select("ord", F.col("line").alias("non_english")), "ord")
    if drop_blank == "pairwise":
        z = z.where((F.col("english") != "") & (F.col("non_english") != ""))
        z = with_ordinal(z.withColumn("_one", F.lit(1)).withColumn("_p", F.lit(0)), ["_p"], "ord", "_one",
                         "_new").drop("ord", "_one", "_p").withColumnRenamed("_new", "ord")
    return cap(z, max_sentences).select("ord", "english", "non_english")
