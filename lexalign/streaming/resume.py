"""Resumable encoding (X1 with the flush interval): sentences are committed in ranges, and a stopped run goes on.

Sentences have a number in their set; ``flush`` consecutive numbers are one unit of a ``UnitTable``.  The pending ranges
are dealt into waves by a hash; a wave is one Spark job that encodes its ranges and commits them together.  What a
stopped run has committed is never encoded again, and what it had not is not seen, so a run that was stopped and
continued gives the rows of one run.  Only the number of pending ranges reaches the driver.

Rows without a number form one range of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexalign.operators.encode import encode
from lexalign.session import checkpoint_dir
from lexalign.sources.units import UnitTable

FLUSH = 10_000
RANGES = 64


def encode_ranges(df: DataFrame, root: str, order_col: str, text_col: str, encoder_factory: Callable, dim: int, set_cols=(),
                  out_col: str = "vec", lang_col: str | None = None, flush: int = FLUSH, ranges: int = RANGES, batch_size: int = 256,
                  element: str = "float", stop_after: int | None = None) -> UnitTable:
    """Encode what ``root`` lacks of ``df`` and return the table of all that is committed.

    ``ranges``: about how many ranges a wave commits.  ``stop_after`` ends the run after so many waves, as a time limit
    would; call again to go on."""
    if flush < 1 or ranges < 1:
        raise ValueError("flush and ranges must be positive")
    keys = [*set_cols, "flush_range"]
    checkpoint_dir(df.sparkSession)
    table = UnitTable(df.sparkSession, root, keys)
    rows = df.withColumn("flush_range", F.floor(F.col(order_col) / F.lit(flush)).cast("long"))
    # what is pending is settled before the first wave; later commits do not change it
    pending = table.pending(rows.select(*keys).distinct()).checkpoint()
    waves = -(-pending.count() // ranges)
    wave = F.pmod(F.xxhash64(*keys), F.lit(max(waves, 1)))
    for k in range(waves if stop_after is None else min(waves, stop_after)):
        units = pending.where(wave == k)
        same = F.lit(True)
        for c in keys:
            same = same & rows[c].eqNullSafe(units[c])
        part = rows.join(units, same, "left_semi")
        table.write(encode(part, text_col, encoder_factory, dim, out_col, lang_col, batch_size, element))
    return table


def encoded(table: UnitTable) -> DataFrame | None:
    """All committed rows, without the range."""
    rows = table.read()
    return None if rows is None else rows.drop("flush_range")
