"""Threshold grid for the sweep.

The grid is a parameter (about 50 values), not data: it is built on the driver the
way the reference builds it — repeated float addition until ``t <= end + 1e-9`` — so
that every value carries both the accumulated ``raw`` float (used to filter during
the sweep) and the ``round(raw, 10)`` value that is reported and used for the
prediction files.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference's default sweep.
DEFAULT_START = 0.1
DEFAULT_END = 5.0
DEFAULT_STEP = 0.1
GRID_SLACK = 1e-9


def threshold_grid(start: float = DEFAULT_START, end: float = DEFAULT_END, step: float = DEFAULT_STEP):
    """List of (idx, raw, rounded) tuples."""
    if not step > 0:
        raise ValueError(f"threshold step must be positive, got {step!r}")
    out = []
    t = float(start)
    i = 0
    while t <= end + GRID_SLACK:
        out.append((i, t, round(t, 10)))
        t += step
        i += 1
    return out


def grid_literal(grid) -> Column:
    """The grid as an ``array<struct<idx:int, raw:double, th:double>>`` literal."""
    return F.array(*[F.struct(F.lit(i).cast("int").alias("idx"), F.lit(float(raw)).cast("double").alias("raw"),
                              F.lit(float(th)).cast("double").alias("th")) for i, raw, th in grid])
