"""Property tests: the one-pass sweep equals a row-by-row replay of the per-threshold
filter + scorer on random inputs with NaN scores, ties, duplicate predictions and
duplicate gold lines; predicted counts never grow with the threshold."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lexalign.functions.grid import threshold_grid
from lexalign.operators.sweep import sweep

from sweep_oracle import sweep_table

GRID = threshold_grid(0.1, 1.0, 0.1)

score = st.one_of(st.sampled_from([0.0, 0.5, 1.0, float("nan")]), st.floats(-2, 2, allow_nan=False))
cand = st.tuples(st.sampled_from("abcd"), st.sampled_from("wxyz"), score)
gold_line = st.tuples(st.sampled_from("abcde"), st.sampled_from("wxyz"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cands=st.lists(cand, min_size=1, max_size=12), gold=st.lists(gold_line, max_size=6),
       method=st.sampled_from(["dynamic", "static"]))
def test_sweep_equals_replay(spark, cands, gold, method):
    c = spark.createDataFrame([("p", "m", "s", a, b, float(x)) for a, b, x in cands],
                              "lang_pair string, model string, split string, src_id string, tgt_id string, "
                              "score double")
    g = spark.createDataFrame([("p", "s", i, a, b) for i, (a, b) in enumerate(gold)],
                              "lang_pair string, split string, line_no long, src_id string, tgt_id string")
    got = sorted(sweep(c, g, method=method, grid=GRID).collect(), key=lambda r: r.idx)
    want = sweep_table(cands, gold, GRID, method)
    assert len(got) == len(want)
    prev = math.inf
    for r, w in zip(got, want):
        assert r.threshold == w[0] and r.predicted == w[1]
        assert (r.precision, r.recall, r.f1) == pytest.approx(w[2:], abs=1e-12)
        assert r.predicted <= prev
        prev = r.predicted
