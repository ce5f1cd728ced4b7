"""Stripes of the kNN join: what is copied, and exact ranks out of a single-precision product."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexalign.operators import knn
from lexalign.operators.knn_index import _assigned, _numbered, centroids

VECS = "g string, sent_id long, vec array<double>"


def _close(rng, n, d):
    """Unit vectors, many of them equal or nearer to each other than single precision can tell."""
    base = rng.normal(size=(5, d))
    x = base[rng.integers(0, 5, n)] + rng.choice([0, 1e-9, 1e-7, 0.5], size=(n, 1)) * rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _want(score, k):
    return [sorted(range(score.shape[1]), key=lambda j: (-score[i, j], j))[:k] for i in range(len(score))]


@pytest.mark.parametrize("d,k,width", [(3, 4, 5000), (64, 7, 90)])
def test_close_scores_are_ranked_in_double(d, k, width):
    rng = np.random.default_rng(d)
    S, T = _close(rng, 700, d), _close(rng, 300, d)
    r = rng.choice([0.1, 0.1 + 1e-9, 0.4], 300)
    C = np.einsum("id,jd->ij", S, T)
    for means, score in ((None, C), (r, 2 * C - r)):
        got = {"s": [], "t": []}
        for side, _, best in knn._multiply(S, T, k, "st", width, means):
            best.cut()
            got[side] += best.kept[1].reshape(-1, k).tolist()
        assert got["s"] == _want(np.round(score, knn.DIGITS), k)
        assert got["t"] == _want(np.round(C.T, knn.DIGITS), k)
    near = pa.array([[0, 2]] * 700, pa.list_(pa.int32()))
    cell = rng.integers(0, 3, 300)
    (_, _, best), = knn._probe(S, T, k, near, cell)
    best.cut()
    assert best.kept[1].reshape(-1, k).tolist() == _want(np.where(cell == 1, -9, np.round(C, knn.DIGITS)), k)


def test_probes_copy_no_vectors(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([("g", i, rng.normal(size=4).tolist()) for i in range(200)], VECS)
    rows = _numbered(df, ["g"], "sent_id", "vec")
    asked = _assigned(rows, centroids(rows, ["g"], 9), ["g"], 6, False, 64)
    assert asked.count() == 200 and asked.where(F.size("near") == 6).count() == 200


def test_few_stripes_for_many_rows(spark):
    rows = spark.range(600_000).select(F.lit("g").alias("g"), F.array_repeat(F.lit(0.125), 64).alias("u"))
    c = knn._stripe_counts(rows, rows, ["g"], knn.DEFAULT_BLOCK_ROWS).first()
    assert (c.nb_s, c.nb_t) == (10, 5)  # 15 copies of a vector on both sides together; blocks alone made 148
    wide = spark.range(9000).select(F.lit("g").alias("g"), F.array_repeat(F.lit(1.0), 2048).alias("u"))
    assert knn._stripe_counts(wide, wide, ["g"], 100).first().nb_s == 12  # at most 800 rows: eight blocks
