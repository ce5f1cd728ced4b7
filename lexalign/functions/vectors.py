"""Vector arithmetic on ``array<float|double>`` columns.

Spark has no built-in vector functions for SQL arrays, so these are higher-order
expressions (``aggregate``/``zip_with``/``transform``).  They stay inside whole-stage
codegen and never leave the JVM.  Arithmetic is done in double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double(v) -> Column:
    return _c(v).cast("array<double>")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a lambda variable).

    Catalyst does not share common subexpressions inside higher-order functions, so
    referencing a computed array twice in a lambda would recompute it per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def l2norm(a) -> Column:
    return F.sqrt(F.aggregate(as_double(a), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a, b) -> Column:
    """Cosine similarity; null when either side has zero norm."""
    return let(l2norm(a) * l2norm(b), lambda den: F.when(den > 0, dot(a, b) / den))


def sq_dist(a, b) -> Column:
    """Sum of squared element differences."""
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, x: acc + x)


def normalize(a) -> Column:
    """Unit vector (null for a zero vector); the norm is computed once per row."""
    return let(as_double(a), lambda v: let(F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)),
                                           lambda n: F.when(n > 0, F.transform(v, lambda x: x / n))))


def quantise(v, digits: int = 6) -> Column:
    """Fixed-point rounding of every element (the ``.vec`` text format keeps 6 decimals).

    Spark rounds half-up where Python's ``%.6f`` rounds the binary value; values that
    differ can only differ by one unit in the last place (1e-6).
    """
    return F.transform(as_double(v), lambda x: F.round(x, digits))
