"""Mining against numpy all-pairs, and the sweep against its definition (``sweep_oracle``)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexalign.functions.grid import threshold_grid
from lexalign.operators.knn import mine
from lexalign.operators.sweep import sweep
from lexalign.sources.fixtures import KEYS, bilingual_fixture

from conftest import SF_SMALL
from sweep_oracle import sweep_table


@pytest.fixture(scope="module")
def fixture(spark):
    src, tgt, gold = bilingual_fixture(spark, SF_SMALL)
    return src.where(F.col("model") == "m15"), tgt.where(F.col("model") == "m15"), gold


def _brute(src_rows, tgt_rows, k, knn):
    out = {}
    groups = {}
    for r in src_rows:
        groups.setdefault(tuple(r[c] for c in KEYS), [[], []])[0].append(r)
    for r in tgt_rows:
        groups.setdefault(tuple(r[c] for c in KEYS), [[], []])[1].append(r)
    for key, (ss, ts) in groups.items():
        if not ss or not ts:
            continue
        S = np.array([r.vec for r in ss]); T = np.array([r.vec for r in ts])
        S /= np.linalg.norm(S, axis=1, keepdims=True); T /= np.linalg.norm(T, axis=1, keepdims=True)
        C = S @ T.T
        rs = np.sort(C, axis=1)[:, ::-1][:, :knn].mean(axis=1)
        rt = np.sort(C.T, axis=1)[:, ::-1][:, :knn].mean(axis=1)
        sc = 2 * C - rs[:, None] - rt[None, :]
        tid = np.array([r.sent_id for r in ts])
        for i, r in enumerate(ss):
            order = sorted(range(len(ts)), key=lambda j: (-sc[i, j], tid[j]))[:k]
            for rank, j in enumerate(order, 1):
                out[key + (r.sent_id, int(tid[j]))] = (rank, sc[i, j])
    return out


@pytest.mark.parametrize("block_rows", [2048, 7])
def test_csls_matches_brute_force(spark, fixture, block_rows):
    src, tgt, _ = fixture
    got = mine(src, tgt, KEYS, k=5, csls_knn=4, block_rows=block_rows).collect()
    want = _brute(src.collect(), tgt.collect(), 5, 4)
    assert len(got) == len(want)
    for r in got:
        rank, sc = want[(r.lang_pair, r.model, r.split, r.src_id, r.tgt_id)]
        assert r.rank == rank
        assert abs(r.score - sc) < 1e-9


def test_zero_vectors_dropped(spark):
    src = spark.createDataFrame([("p", "m", "s", 1, [0.0, 0.0]), ("p", "m", "s", 2, [1.0, 0.0])],
                                "lang_pair string, model string, split string, sent_id long, vec array<double>")
    out = mine(src, src, KEYS, k=2, method="cosine").collect()
    assert {(r.src_id, r.tgt_id) for r in out} == {(2, 2)}
    with pytest.raises(ValueError):
        mine(src, src, KEYS, method="nope")


def test_repeats_and_ties_do_not_depend_on_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 8))
    rows = [("p", "m", "s", i // 2, base[i % 6].tolist()) for i in range(40)]  # repeated ids and repeated vectors
    df = spark.createDataFrame(rows, "lang_pair string, model string, split string, sent_id long, vec array<double>")
    got = [sorted((r.src_id, r.tgt_id, r.rank, round(r.score, 9)) for r in mine(df, df, KEYS, k=3, csls_knn=4, block_rows=b).collect())
           for b in (3, 17, 2048)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 120


def test_non_finite_vectors_fail(spark):
    df = spark.createDataFrame([("p", "m", "s", 1, [float("nan"), 1.0])],
                               "lang_pair string, model string, split string, sent_id long, vec array<double>")
    with pytest.raises(Exception, match="non-finite"):
        mine(df, df, KEYS, k=1).collect()


def test_zero_vector_is_a_miss(spark):
    from lexalign.operators.distill import translation_accuracy

    df = spark.createDataFrame([("m", 1, [1.0, 0.0]), ("m", 2, [0.0, 1.0]), ("m", 3, [0.0, 0.0])],
                               "model string, sent_id long, vec array<double>")
    r = translation_accuracy(df, df, ["model"]).first()
    assert r.src2trg == r.trg2src == r.accuracy == pytest.approx(2 / 3)


@pytest.mark.parametrize("method", ["dynamic", "static"])
def test_sweep_matches_replay(spark, fixture, method):
    src, tgt, gold = fixture
    c = mine(src, tgt, KEYS, k=3)
    grid = threshold_grid()
    sw = sweep(c, gold, method=method, grid=grid).collect()
    cands = c.collect()
    golds = gold.collect()
    by_group = {}
    for r in sw:
        by_group.setdefault((r.lang_pair, r.model, r.split), []).append(r)
    for key, rows in by_group.items():
        cg = [x for x in cands if (x.lang_pair, x.model, x.split) == key]
        gg = [x for x in golds if (x.lang_pair, x.split) == (key[0], key[2])]
        want = sweep_table([(x.src_id, x.tgt_id, x.score) for x in cg],
                           [(x.src_id, x.tgt_id) for x in sorted(gg, key=lambda x: x.line_no)], grid, method)
        rows.sort(key=lambda r: r.idx)
        assert len(rows) == len(want)
        for r, w in zip(rows, want):
            assert r.threshold == w[0]
            assert (r.precision, r.recall, r.f1) == pytest.approx(w[2:], abs=1e-12)


def test_predicted_non_increasing(spark, fixture):
    src, tgt, gold = fixture
    sw = sweep(mine(src, tgt, KEYS, k=3), gold).collect()
    by = {}
    for r in sw:
        by.setdefault((r.lang_pair, r.model, r.split), []).append((r.idx, r.predicted))
    for v in by.values():
        p = [x for _, x in sorted(v)]
        assert all(a >= b for a, b in zip(p, p[1:]))
