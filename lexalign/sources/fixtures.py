"""Inputs derived by Spark from the given tables.

The mining benchmark needs sentence vectors for two languages, split names and a gold
alignment; the given ``embeddings`` table supplies vectors, so the bilingual fixture is
*derived* from it (every row of the table takes part).  The distillation half needs
line-aligned parallel text; it is derived from ``documents``.

Bilingual rule (fixed values; ``n`` = row count of ``embeddings``):

* ``lang_pair``  = element ``label % 4`` of PAIRS
* ``split``      = ``train`` if ``floor(vec_id / 10) % 2 = 0`` else ``test``
* ``model``      = one of MODELS, each with a noise weight ``alpha``
* source side    = rows with ``vec_id % 5 <> 0``, vector = embedding
* target side    = rows with ``vec_id % 5 <> 1``, vector = embedding + alpha * embedding of row
  ``(vec_id + SHIFT) % n``
* gold           = rows with ``vec_id % 5 not in (0, 1)``: src = tgt = vec_id.  The gold
  *file* lists every such source twice: first a stale line pointing at row
  ``(vec_id + SHIFT) % n`` (line ``2 * vec_id``), then the true line (``2 * vec_id + 1``);
  the reference's last-line-wins rule must keep the true partner.

The modulo rules decide which sentences have a partner (both sides also hold sentences
without one, as real mining corpora do); they are not a sample — every row is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.functions.vectors import as_double

# Fixed values of the derived bilingual fixture.
PAIRS = ["chv-ru", "dsb-de", "hsb-de", "oci-es"]
MODELS = [("m05", 0.5), ("m10", 1.0), ("m15", 1.5)]
SHIFT = 137
SPLIT_PERIOD = 10

KEYS = ["lang_pair", "model", "split"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tagged(emb: DataFrame) -> DataFrame:
    pairs = F.array(*[F.lit(p) for p in PAIRS])
    return emb.select(
        "vec_id", "embedding",
        F.element_at(pairs, (F.pmod(F.col("label"), F.lit(len(PAIRS))) + 1).cast("int")).alias("lang_pair"),
        F.when(F.pmod(F.floor(F.col("vec_id") / SPLIT_PERIOD), F.lit(2)) == 0, F.lit("train"))
        .otherwise(F.lit("test")).alias("split"))


def _models_col():
    return F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(float(a)).alias("alpha"))
                               for m, a in MODELS])).alias("m")


def bilingual_fixture(spark: SparkSession, sf_dir: str, models=None):
    """Returns ``(src, tgt, gold)``.

    * src / tgt: ``(lang_pair, model, split, sent_id bigint, vec array<double>)``
    * gold: ``(lang_pair, split, line_no bigint, src_id bigint, tgt_id bigint)``
    """
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    n = emb.select(F.count(F.lit(1))).scalar()
    tagged = _tagged(emb)

    src = (tagged.where(F.pmod("vec_id", F.lit(5)) != 0)
           .select("*", _models_col())
           .select("lang_pair", F.col("m.model").alias("model"), "split", F.col("vec_id").alias("sent_id"),
                   as_double("embedding").alias("vec")))

    shifted = emb.select(F.col("vec_id").alias("other_id"), F.col("embedding").alias("other"))
    tgt_base = (tagged.where(F.pmod("vec_id", F.lit(5)) != 1)
                .withColumn("other_id", F.pmod(F.col("vec_id") + SHIFT, n))
                .join(shifted, "other_id"))
    tgt = (tgt_base.select("*", _models_col())
           .select("lang_pair", F.col("m.model").alias("model"), "split", F.col("vec_id").alias("sent_id"),
                   F.zip_with(as_double("embedding"), as_double("other"),
                              lambda x, y: x + F.col("m.alpha") * y).alias("vec")))

    lines = F.explode(F.array(
        F.struct((F.col("vec_id") * 2).alias("line_no"), F.pmod(F.col("vec_id") + SHIFT, n).alias("tgt_id")),
        F.struct((F.col("vec_id") * 2 + 1).alias("line_no"), F.col("vec_id").alias("tgt_id")))).alias("g")
    gold = (tagged.where(~F.pmod("vec_id", F.lit(5)).isin(0, 1))
            .select("lang_pair", "split", F.col("vec_id").alias("src_id"), lines)
            .select("lang_pair", "split", F.col("g.line_no").alias("line_no"), "src_id",
                    F.col("g.tgt_id").alias("tgt_id")))
    if models is not None:
        src = src.where(F.col("model").isin(list(models)))
        tgt = tgt.where(F.col("model").isin(list(models)))
    return src, tgt, gold


__all__ = ["bilingual_fixture", "table", "PAIRS", "MODELS", "SHIFT", "KEYS"]


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence sets of the fixture: ``(lang_pair, split, lang, sent_id)`` — source-side rows
    carry the pair's first language, target-side rows its second."""
    t = _tagged(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    langs = F.split("lang_pair", "-")
    src = t.where(F.pmod("vec_id", F.lit(5)) != 0).select("lang_pair", "split", F.element_at(langs, 1).alias("lang"),
                                                          F.col("vec_id").alias("sent_id"))
    tgt = t.where(F.pmod("vec_id", F.lit(5)) != 1).select("lang_pair", "split", F.element_at(langs, 2).alias("lang"),
                                                          F.col("vec_id").alias("sent_id"))
    return src.unionByName(tgt)


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pair, fname)``: the corpus files the fixture stands for (sentence files and gold files)."""
    s = sentences(spark, sf_dir)
    sent = s.select(F.col("lang_pair").alias("pair"), F.concat_ws(".", "lang_pair", "split", "lang").alias("fname"))
    gold = s.select(F.col("lang_pair").alias("pair"), F.concat_ws(".", "lang_pair", "split", F.lit("gold")).alias("fname"))
    return sent.unionByName(gold).distinct()
