"""deckforge: language-study deck preparation as Spark table operators."""

import sys as _sys

__version__ = "0.1.0"


def _ship_functions_by_value() -> None:
    """Pickle deckforge's functions (UDF bodies, mapInPandas callbacks) by
    value, so Python workers need not have the package installed or on their
    path; a cluster runs the code the driver imported."""
    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark is a hard dependency
        return
    cloudpickle.register_pickle_by_value(_sys.modules[__name__])


_ship_functions_by_value()
