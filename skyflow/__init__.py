"""PySpark-native building blocks for wide-field sky-survey reduction.

Every operator takes and returns DataFrames (or Columns), so jobs compose with
``df.transform(...)`` and the physical strategy is left to Catalyst and AQE.
"""

from __future__ import annotations


def ship_by_value() -> None:
    """Pickle this package by value so executors need no copy of it on their path.

    A cluster job started with ``--py-files`` does not need this.
    """
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
