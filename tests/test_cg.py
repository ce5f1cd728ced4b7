"""Block conjugate gradients against a direct solver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexalign.operators import cg
from lexalign.operators.distill import gram_statistics, solve_ridge

SCHEMA = "system string, x array<double>, y array<double>"


@pytest.fixture(scope="module")
def gram(spark):
    rng = np.random.default_rng(3)
    rows = []
    for name, scale in (("a", 1.0), ("b", 3.0)):
        x = rng.normal(size=(60, 6)) * scale + 1
        y = x @ rng.normal(size=(6, 3)) + rng.normal(size=(60, 3))
        y[:, 2] *= name == "a"  # a column of zeros
        rows += [(name, u.tolist(), v.tolist()) for u, v in zip(x, y)]
    return gram_statistics(spark.createDataFrame(rows, SCHEMA), "x", "y", ["system"]).checkpoint()


def _weights(df, system):
    return np.array([r.w for r in df.where(F.col("system") == system).orderBy("i").collect()])


def test_solution_is_the_direct_one(spark, gram):
    w = cg.solve(gram, 2.0, block=4)
    for s in "ab":
        assert np.abs(_weights(w, s) - solve_ridge(gram.where(F.col("system") == s), 2.0)).max() < 1e-7
    assert w.count() == 12


def test_two_stages(spark, gram):
    one, two = (gram.where(F.col("system") == s).withColumn("system", F.lit("s")) for s in "ab")
    got = cg.two_stage(one, two, 5.0, block=4)
    first = solve_ridge(one, 5.0)
    assert np.abs(_weights(got["stage2"], "s") - solve_ridge(two, 5.0, first)).max() < 1e-7
    reused = cg.two_stage(None, two, 5.0, stage1=got["stage1"], block=4)
    assert np.abs(_weights(reused["stage2"], "s") - _weights(got["stage2"], "s")).max() < 1e-7
    single = cg.two_stage(None, two, 5.0, mode="single-stage", block=4)
    assert np.abs(_weights(single["stage2"], "s") - solve_ridge(two, 5.0)).max() < 1e-7
    sides = cg.normal_sides(two, got["stage2"], 5.0, got["stage1"], 4)
    assert sides.count() == 18 and sides.agg(F.max(F.abs(F.col("left") - F.col("xty")))).first()[0] < 1e-6
    with pytest.raises(ValueError):
        cg.two_stage(one, two, mode="three")
    with pytest.raises(ArithmeticError):
        cg.solve(two, rounds=1)


def test_a_prior_that_solves_it_stays(spark, gram):
    w = cg.solve(gram, 2.0, block=5)
    big = cg.solve(gram, 1e12, w, block=5)  # shrunk towards the prior with all weight
    assert np.abs(_weights(big, "a") - _weights(w, "a")).max() < 1e-6
