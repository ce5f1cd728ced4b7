"""Registered queries of the operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as DC
from . import katz as KZ
from . import license_scan as LS
from . import line_dedup as LD
from . import near_dedup as ND
from . import packing as PK
from . import ranked_search as RS
from . import secret_scan as SS
from . import spelling as SL
from . import spotsigs as SP
from . import suffix_dedup as SD
from . import toxicity as TX
from . import warc as WA
from . import words as W
from .oracle import ORACLE


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SP.compare_next(_read(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    store = WA.archive(pages, min_bytes=0)
    found = WA.lookup(spark, pages, store)
    return WA.read_records(found, store).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ND.near_duplicates(_read(spark, sf_dir, "documents"), kind=W.NOT_SPACE, n=4, percent=80)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LS.scan(_read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held = TX.held_out(F.col("doc_id"), 5, 0)
    model = TX.train(docs, _read(spark, sf_dir, "labels"), held)
    return TX.score(docs, model).select("doc_id", held.alias("held_out"), "score",
                                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return KZ.score(_read(spark, sf_dir, "documents"), KZ.held_out(F.col("doc_id"), 7, 2), every=True)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = LD.dedup_lines(_read(spark, sf_dir, "documents"), min_chars=10, min_docs=2)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = DC.scan(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), n=10)
    signs = F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))  # ends minus starts
    hit = F.aggregate(signs, F.lit(0), lambda acc, x: acc + x)
    return found.select("doc_id", "n_words", hit.cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SD.remove_repeats(_read(spark, sf_dir, "documents"), size=400).drop("spans")


def tokenizer_spec() -> str:
    """Content of the public tokenizer file (about 2 MB), read where the query is declared."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PK.pack(_read(spark, sf_dir, "documents"), tokenizer_spec(), end_id=1, seq=2048)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SL.variants(_read(spark, sf_dir, "documents"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = SS.secrets(_read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(SS.BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(SS.joined(base), 256).alias("base_sha256"), SS.joined(F.col("spans")).alias("spans"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RS.rank(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), k=50)


QUERIES = {
    "op1_spotsigs": op1_spotsigs,
    "op2_warc": op2_warc,
    "op3_near_dedup": op3_near_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_toxicity": op5_toxicity,
    "op6_katz": op6_katz,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_packing": op10_packing,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_secret_scan": op12_secret_scan,
    "op13_ranked_search": op13_ranked_search,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
