"""Text formats at line level (S1, S3-S6, K1, K2): lines rendered from the given tables, with short, long and bad ones,
parsed back in quarantine mode, so that no query needs a folder of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.operators.sweep import SWEEP_COLUMNS
from lexalign.plans.registered import threshold_sweep, transfer_summary_q
from lexalign.session import scratch_path
from lexalign.sources import sinks, text
from lexalign.sources.fixtures import KEYS, bilingual_fixture, table
from lexalign.sources.quarantine import divert
from lexalign.sources.vec_file import write_vec_files
from lexalign.streaming.incremental import pending_units


def _lines(df: DataFrame, file: Column, line_no: str, value: Column) -> DataFrame:
    return df.select(file.alias("file"), F.col(line_no).alias("line_no"), value.alias("value"))


def _sentence_lines(spark, sf_dir) -> DataFrame:
    """One line per document: line 3 of ten lacks its text, line 7 has a field too many."""
    d = table(spark, sf_dir, "documents")
    ident = F.col("doc_id").cast("string")
    body = F.translate("text", "\t\n", "  ")
    rest = F.pmod("doc_id", F.lit(10))
    value = F.when(rest == 3, ident).when(rest == 7, F.concat_ws("\t", ident, F.lit("word"), F.lit("extra"))).otherwise(
        F.concat_ws("\t", ident, body))
    file = F.concat(F.lit("/c/oci-es/oci-es.train."), F.col("lang"))
    return _lines(d, file, "doc_id", value)


def parse_sentences_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.parse_sentences(_sentence_lines(spark, sf_dir), on_bad="quarantine")


def quarantine_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of the diverted sentence lines by language, beside the counts observed in the one scan."""
    d = divert(text.parse_sentences(_sentence_lines(spark, sf_dir), on_bad="quarantine"), scratch_path(spark, "quarantine"))
    rows = [x.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("n_chars")).select(
        F.lit(kind).alias("kind"), "lang", "n_rows", "n_chars", F.lit(n).cast("long").alias("observed"))
        for kind, x, n in (("good", d.good, d.n_good), ("bad", d.bad, d.n_bad))]
    return rows[0].unionByName(rows[1])


def vec_file_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 as one file per set, read back line by line."""
    src, _, _ = bilingual_fixture(spark, sf_dir)
    root = scratch_path(spark, "vec")
    write_vec_files(src, root, KEYS, "sent_id")
    lines = text.read_lines(spark, root)
    name = F.split(F.element_at(F.split("file", "/"), -1), r"\.")
    return lines.select(*[name[i].alias(k) for i, k in enumerate(KEYS)], F.col("line_no").alias("line"), "value")


def _ids(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id")


def parse_gold_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ident = F.col("vec_id").cast("string")
    value = F.when(F.pmod("vec_id", F.lit(10)) == 4, ident).otherwise(
        F.concat_ws("\t", ident, (F.col("vec_id") + 1).cast("string")))
    return text.parse_pairs(_lines(_ids(spark, sf_dir), F.lit("/c/hsb-de.test.gold"), "vec_id", value), "gold", on_bad="quarantine")


def parse_candidates_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from directories; scores that Python's ``float`` takes and one that it does not."""
    scores = F.array(*[F.lit(x) for x in ("0.5", "1e-3", "nan", "0.5d", "1_0.25", "-inf", "")])
    ident = F.col("vec_id").cast("string")
    score = F.element_at(scores, (F.pmod("vec_id", F.lit(7)) + 1).cast("int"))
    value = F.when(F.pmod("vec_id", F.lit(11)) == 5, F.concat_ws("\t", ident, ident)).otherwise(
        F.concat_ws("\t", ident, ident, score, F.lit("more")))
    file = F.lit("/s/lang_pair=hsb-de/model=m05/split=test/part-00000-x.c000")
    c = text.parse_candidates(_lines(_ids(spark, sf_dir), file, "vec_id", value), on_bad="quarantine")
    kind = F.when(F.col("score").isNull(), "none").when(F.isnan("score"), "nan").when(
        F.abs("score") == float("inf"), "inf").otherwise("number")
    return c.select("lang_pair", "split", "model", "line_no", "src_id", "tgt_id", "bad", kind.alias("kind"),
                    F.when(kind == "number", F.col("score")).alias("score"))


def parse_vec_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header line (number 0), blank lines, and ``id v1 v2 v3``."""
    ident = F.col("vec_id").cast("string")
    value = F.when(F.col("vec_id") == 0, F.lit("9 3")).when(F.pmod("vec_id", F.lit(9)) == 2, F.lit("  ")).otherwise(
        F.concat_ws(" ", ident, F.lit("0.5"), (F.col("vec_id") * 0.25).cast("decimal(20,2)").cast("string"), F.lit("-1.25")))
    v = text.parse_vec(_lines(_ids(spark, sf_dir), F.lit("/v/hsb-de.test.hsb.m05.vec"), "vec_id", value))
    return v.select("lang_pair", "split", "lang", "model", "line_no", "sent_id",
                    *[F.col("vec")[k].cast("double").alias(f"v{k}") for k in range(3)])


def vec_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, _, _ = bilingual_fixture(spark, sf_dir)
    return sinks.vec_lines(src, KEYS, "sent_id").select(*KEYS, F.col("_o").alias("line"), "value")


def prediction_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source row with the next id as its prediction, as text lines."""
    src, _, _ = bilingual_fixture(spark, sf_dir)
    return sinks.prediction_lines(src.select(*KEYS, F.col("sent_id").alias("src_id"), (F.col("sent_id") + 1).alias("tgt_id")), KEYS)


def _next_ids(spark, sf_dir, step: int) -> DataFrame:
    src, _, _ = bilingual_fixture(spark, sf_dir)
    return src.select(*KEYS, F.col("sent_id").alias("src_id"), (F.col("sent_id") + step).alias("tgt_id"))


def unit_predictions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 with commits, and S5: predictions of all units, then those of one model again; a later run that was never
    committed is not seen.  The committed text lines are parsed back."""
    t = sinks.unit_table(spark, scratch_path(spark, "predictions"), KEYS, text=True)
    t.write(sinks.prediction_lines(_next_ids(spark, sf_dir, 1), KEYS))
    t.write(sinks.prediction_lines(_next_ids(spark, sf_dir, 2).where("model = 'm10'"), KEYS))
    t.stage(sinks.prediction_lines(_next_ids(spark, sf_dir, 3).where("model = 'm15'"), KEYS))
    folder = F.concat(*[x for k in KEYS for x in (F.lit(f"/{k}="), F.col(k))], F.lit("/part-0"))
    back = text.parse_pairs(t.read().select(folder.alias("file"), F.lit(0).alias("line_no"), "value"), "prediction")
    model = F.regexp_extract("file", "model=([^/]+)", 1).alias("model")
    return back.select("lang_pair", model, "split", F.col("src_id").cast("long").alias("src_id"), F.col("tgt_id").cast("long").alias("tgt_id"))


def unit_commits_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The committed units with their row counts and versions: one pair is written after the others, one never."""
    t = sinks.unit_table(spark, scratch_path(spark, "candidates"), KEYS)
    rows = _next_ids(spark, sf_dir, 1)
    t.write(rows.where("lang_pair <> 'oci-es'"))
    t.write(rows.where("lang_pair = 'hsb-de' and src_id % 2 = 0"))
    return t.units().select(*KEYS, "n_rows", "version")


def pending_listing_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 on real outputs: vectors of two models are written, those of the third without the marker of a finished write."""
    src, _, _ = bilingual_fixture(spark, sf_dir)
    root = scratch_path(spark, "outputs")
    for model, done in (("m05", "true"), ("m10", "false"), ("m15", "true")):
        out = src.where(F.col("model") == model).drop("model")
        out.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", done).partitionBy("lang_pair", "split").parquet(f"{root}/{model}")
    work = src.select(*KEYS).distinct().withColumn("output_path", F.concat_ws("/", F.lit(root), "model"))
    return pending_units(spark, work, KEYS).select(*KEYS)


def sweep_csv_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the sweep as CSV, read back."""
    path = scratch_path(spark, "sweep")
    sinks.write_sweep(threshold_sweep(spark, sf_dir), path)
    kinds = {c: "string" if c in KEYS else "double" for c in SWEEP_COLUMNS}
    return spark.read.option("header", True).schema(", ".join(f"{c} {k}" for c, k in kinds.items())).csv(path)


def summary_csv_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: the transfer summary as CSV, read back."""
    path = scratch_path(spark, "summary")
    rows = transfer_summary_q(spark, sf_dir)
    sinks.write_summary(rows, path)
    return spark.read.option("header", True).schema(rows.select(*sinks.SUMMARY_COLUMNS).schema).csv(path)
