"""The vector index against the exact join."""

import pytest
from pyspark.sql import functions as F

from lexalign.operators.knn import mine
from lexalign.operators.knn_index import VectorIndex, mine_indexed, probes_for, recall
from lexalign.sources.fixtures import KEYS, bilingual_fixture

from conftest import SF_MID, SF_SMALL

VECS = "lang_pair string, model string, split string, sent_id long, vec array<double>"


def _one_group(spark, sf):
    """All vectors of a model as one group, so that there are more cells."""
    src, tgt, _ = bilingual_fixture(spark, sf, ["m10"])
    return [x.select(F.lit("all").alias("lang_pair"), F.lit("m").alias("model"), F.lit("s").alias("split"), "sent_id", "vec") for x in (src, tgt)]


def test_recall_of_default_probes(spark):
    src, tgt, _ = bilingual_fixture(spark, SF_MID)
    rows = recall(mine_indexed(src, tgt, KEYS, k=10), mine(src, tgt, KEYS, k=10, method="cosine"), KEYS).collect()
    assert sum(r.found_n for r in rows) >= 0.9 * sum(r.exact_n for r in rows)
    assert all(r.recall >= 0.9 for r in rows) and len(rows) == 24


@pytest.mark.parametrize("method", ["cosine", "csls"])
def test_recall_with_many_cells(spark, method):
    src, tgt = _one_group(spark, SF_MID)
    found = mine_indexed(src, tgt, KEYS, k=10, method=method, csls_knn=10)
    row = recall(found, mine(src, tgt, KEYS, k=10, method=method, csls_knn=10), KEYS).first()
    assert row.recall >= 0.9 and row.exact_n == 10 * src.count()


@pytest.mark.parametrize("method,block_rows", [("cosine", 8192), ("cosine", 7), ("csls", 50)])
def test_all_probes_are_the_exact_join(spark, method, block_rows):
    src, tgt = _one_group(spark, SF_SMALL)
    src = src.limit(80).unionByName(src.limit(5))  # repeated rows are ranked each on their own
    got = mine_indexed(src, tgt, KEYS, k=4, method=method, csls_knn=4, cells=9, probes=9, block_rows=block_rows)
    want = mine(src, tgt, KEYS, k=4, method=method, csls_knn=4)
    cols = ["src_id", "tgt_id", "rank", F.round("cos", 8).alias("c"), F.round("score", 8).alias("s")]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_every_vector_is_indexed_once(spark):
    _, tgt = _one_group(spark, SF_SMALL)
    index = VectorIndex(tgt, KEYS, sample=40, block_rows=16)
    assert index.cells.select("id").distinct().count() == index.cells.count() == tgt.count()
    assert index.centroids.first().cells == 5  # an eighth of the sample
    near = index.search(tgt, 1)  # its own cell comes first, so a vector finds itself
    assert near.where(F.col("best")[0]["id"] != F.col("src_id")).count() == 0


def test_odd_vectors(spark):
    rows = [("p", "m", "s", 1, [0.0, 0.0]), ("p", "m", "s", 2, [1.0, 0.0]), ("p", "m", "s", 3, None), ("q", "m", "s", 4, [0.0, 2.0])]
    tgt = spark.createDataFrame([("p", "m", "s", 9, [2.0, 0.0]), ("p", "m", "s", 8, [1.0, 0.0]), ("r", "m", "s", 7, [1.0, 1.0])], VECS)
    src = spark.createDataFrame(rows, VECS)
    assert [tuple(r)[3:6] for r in mine_indexed(src, tgt, KEYS, k=1).collect()] == [(2, 8, 1)]
    assert mine_indexed(src.limit(0), tgt, KEYS).count() == mine_indexed(src, tgt.limit(0), KEYS).count() == 0
    with pytest.raises(Exception, match="non-finite"):
        mine_indexed(spark.createDataFrame([("p", "m", "s", 1, [float("nan"), 0.0])], VECS), tgt, KEYS).count()
    with pytest.raises(ValueError):
        mine_indexed(src, tgt, KEYS, probes=0)
    assert [probes_for(c) for c in (1, 4, 15, 1024)] == [1, 4, 13, 174]
