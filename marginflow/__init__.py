"""marginflow: support-vector classification and training-data operators as
Spark DataFrame jobs.

Layout
------
sources/    delimited text, name/type files, fixture tables built from parquet
functions/  column expressions (kernels, SMO bounds and steps) and the
            NumPy block kernels used inside Arrow tasks
operators/  DataFrame -> DataFrame operators: preparation, kernel scoring,
            dual-state steps, trainers, metrics
plans/      the end-to-end train/evaluate run and the query catalog
llm/        operators of a training-data pipeline

Scoring is a stateless map and also works on streaming DataFrames.
"""

__version__ = "0.1.0"

import sys as _sys

try:  # ship this package's functions to Python workers by value, so task
    # closures work without installing the package on every executor
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
