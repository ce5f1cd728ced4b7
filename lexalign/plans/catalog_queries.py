"""Catalog and work-planning queries over the fixture's sentence sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.operators.catalog import (DEFAULT_MODELS, corpus_catalog_from_names, models_df, resolve_lang_codes,
                                        run_report, select_pairs, with_input_status, with_status, work_list)
from lexalign.operators.isolate import run_units
from lexalign.session import scratch_path
from lexalign.sources.fixtures import MODELS, bilingual_fixture, file_names, sentences
from lexalign.sources.units import UnitTable

# The fixture's models join the default list (they have vectors; the others do not).
CONFIG_MODELS = DEFAULT_MODELS + [{"name": m} for m, _ in MODELS]
REQUESTED_PAIRS = ["hsb-de", "dsb-de", "cs-de"]
REQUESTED_SPLITS = ["test", "train"]


def _catalog(spark, sf_dir):
    return corpus_catalog_from_names(file_names(spark, sf_dir))


def corpus_catalog_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir).select("pair", F.array_join("splits", ",").alias("splits"))


def select_pairs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    sel, missing = select_pairs(_catalog(spark, sf_dir), REQUESTED_PAIRS)
    return (sel.select("pair", F.lit("selected").alias("status"))
            .unionByName(missing.select("pair", F.lit("missing").alias("status"))))


def lang_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = sentences(spark, sf_dir).groupBy("lang_pair", "lang").agg(F.count(F.lit(1)).alias("n_sentences"))
    models = models_df(spark, CONFIG_MODELS)
    aliases = [m.get("alias", m["name"]) for m in CONFIG_MODELS]
    u = units.select("*", F.explode(F.array(*[F.lit(a) for a in aliases])).alias("model"))
    return resolve_lang_codes(u, models).select("model", "lang_pair", "lang", "code", "is_proxy", "is_default",
                                                "note", "n_sentences")


def proxy_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_codes(spark, sf_dir).where(F.col("is_proxy")).select("model", "lang", "code", "note").distinct()


def work_list_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work_list(_catalog(spark, sf_dir), models_df(spark, CONFIG_MODELS), "embed").drop("model_idx")


UNIT = ["model", "lang_pair", "split", "lang"]


def _embed_status(spark, sf_dir):
    catalog = _catalog(spark, sf_dir)
    _, missing = select_pairs(catalog, REQUESTED_PAIRS)  # asked for, but without files: its units are skipped
    asked = missing.withColumn("splits", F.array(*[F.lit(s) for s in REQUESTED_SPLITS]))
    w = work_list(catalog.unionByName(asked), models_df(spark, CONFIG_MODELS), "embed")
    w = with_input_status(w, sentences(spark, sf_dir), ["lang_pair", "split", "lang"])
    src, tgt, _ = bilingual_fixture(spark, sf_dir)
    langs = F.split("lang_pair", "-")
    done = (src.select("model", "lang_pair", "split", F.element_at(langs, 1).alias("lang"))
            .unionByName(tgt.select("model", "lang_pair", "split", F.element_at(langs, 2).alias("lang"))))
    return with_status(w, done, UNIT)


def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embed_status(spark, sf_dir).where(F.col("status") == "ran").select("stage", "model", "lang_pair", "split",
                                                                              "lang")


def _count_lengths(part):
    """The stand-in for an encoder stage: a model that maps languages refuses one that its map lacks."""
    if part["refused"].iloc[0]:
        raise ValueError(f"no language code for {part['lang'].iloc[0]}")
    return part.assign(n_chars=part["sent_id"].astype(str).str.len())


def _run_pending(spark, sf_dir):
    """Statuses after the pending units ran over all their sentences, each unit alone."""
    before = _embed_status(spark, sf_dir).checkpoint()
    models = models_df(spark, CONFIG_MODELS)
    todo = before.where(F.col("status") == "ran").select(*UNIT)
    mapped = models.where(F.col("lang_map").isNotNull()).select(F.coalesce("alias", "name").alias("model"), F.lit(True).alias("mapped"))
    rows = (resolve_lang_codes(todo, models).join(mapped, "model", "left").join(sentences(spark, sf_dir), ["lang_pair", "split", "lang"])
            .select(*UNIT, "sent_id", (F.col("mapped").isNotNull() & F.col("is_default")).alias("refused")))
    table = UnitTable(spark, scratch_path(spark, "embed"), UNIT)
    schema = "model string, lang_pair string, split string, lang string, sent_id long, n_chars int"
    return before, run_units(rows, todo, table, _count_lengths, schema), table


def run_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after, _ = _run_pending(spark, sf_dir)
    done = before.where(F.col("status") == "done")
    return run_report(with_status(before.drop("status"), done, UNIT, after.where(F.col("status") == "failed")))


def failed_units_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units that failed, with their messages, and those that ran, with the rows that were committed for them."""
    _, after, table = _run_pending(spark, sf_dir)
    return after.join(table.units().select(*UNIT, "n_rows"), UNIT, "left").select(
        *UNIT, "status", "error", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))
