"""Units that fail alone (A7, J2): one broken unit becomes a ``failed`` row, the others finish.

``isolate`` runs a Python function over Arrow batches and catches what it raises per unit and batch, so a unit's rows may
lie in any number of tasks.  ``settle`` then drops all rows of a unit that failed anywhere and lists the failures;
``run_units`` commits what is left to a ``UnitTable`` in one step and returns a status per unit.

Only errors of the function are caught; a lost executor is Spark's business (the task runs again).  A unit is one value
of the key columns, null included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexalign.sources.units import UnitTable

ERROR = "_error"


def same(left: DataFrame, right: DataFrame, cols) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & left[c].eqNullSafe(right[c])
    return out


def isolate(df: DataFrame, keys, fn: Callable, schema: str) -> DataFrame:
    """``schema`` (which holds the keys) and ``_error``: the rows of ``fn(part) -> DataFrame`` for the part of each unit in
    each batch, or one row with the unit's keys and the message if it raised."""
    keys = list(keys)
    names = [f.name for f in df.sparkSession.createDataFrame([], schema).schema]

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for _, at in pdf.groupby(keys, sort=False, dropna=False).indices.items() if len(pdf) else ():
                part = pdf.iloc[at]
                try:
                    yield fn(part.reset_index(drop=True))[names].assign(**{ERROR: None})
                except Exception as e:  # whatever the unit's rows make the function raise
                    row = {n: [part[n].iloc[0] if n in keys else None] for n in names}
                    yield pd.DataFrame(row | {ERROR: [f"{type(e).__name__}: {e}"]}, dtype=object)

    return df.mapInPandas(run, f"{schema}, {ERROR} string")


def settle(result: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """``(good, failures)`` of a stored ``isolate`` result: rows of units without any error, and ``(keys, error)``."""
    keys = list(keys)
    failures = result.where(F.col(ERROR).isNotNull()).groupBy(*keys).agg(F.min(ERROR).alias("error"))
    good = result.where(F.col(ERROR).isNull()).drop(ERROR)
    return good.join(failures, same(good, failures, keys), "left_anti"), failures


def run_units(rows: DataFrame, work: DataFrame, table: UnitTable, fn: Callable, schema: str) -> DataFrame:
    """Run ``fn`` on the rows of the pending units of ``work`` and commit those that finished.

    Returns ``(keys, status, error)`` for every unit of ``work``: ``done`` (committed before), ``skipped`` (no rows),
    ``failed`` or ``ran``."""
    keys = table.keys
    todo = table.pending(work.select(*keys).distinct()).checkpoint()
    asked = rows.join(todo, same(rows, todo, keys), "left_semi")
    result = isolate(asked, keys, fn, schema).checkpoint()
    good, failures = settle(result, keys)
    failures = failures.checkpoint()
    have = asked.select(*keys).distinct()
    ran = have.join(failures, same(have, failures, keys), "left_anti").checkpoint()
    table.write(good, units=ran)
    unit = work.select(*keys).distinct()
    for name, part in (("_todo", todo), ("_ran", ran)):
        flag = part.select(*keys).withColumn(name, F.lit(True))
        unit = unit.join(flag, same(unit, flag, keys), "left").select(*[unit[c] for c in unit.columns], name)
    unit = unit.join(failures, same(unit, failures, keys), "left").select(*[unit[c] for c in unit.columns], "error")
    status = (F.when(F.col("_todo").isNull(), "done").when(F.col("error").isNotNull(), "failed")
              .when(F.col("_ran").isNotNull(), "ran").otherwise("skipped"))
    return unit.select(*keys, status.alias("status"), "error")
