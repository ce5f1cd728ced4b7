"""lexalign — bilingual sentence mining and distillation data prep as Spark DataFrame plans."""

import sys as _sys

__version__ = "0.1.0"


def _pickle_by_value() -> None:
    # Python workers need the few helpers used inside Arrow tasks; shipping them by value
    # means executors need no installed copy of this package.
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(_sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_pickle_by_value()
