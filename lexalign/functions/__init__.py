"""Column-level building blocks (all JVM-side Catalyst expressions)."""

from lexalign.functions.vectors import cosine, dot, l2norm, quantise, sq_dist  # noqa: F401
from lexalign.functions.grid import threshold_grid, grid_literal  # noqa: F401
from lexalign.functions.text import strip_unicode, STRIP_PATTERN  # noqa: F401
