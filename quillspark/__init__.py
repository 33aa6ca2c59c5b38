"""quillspark: social-post and price-series analytics expressed as Spark DataFrame jobs.

Sub-packages
------------
sources    table readers, CSV readers, fixture views, sinks and stage cache
functions  Column-level expressions (text normalisation, formats, statistics helpers)
operators  DataFrame -> DataFrame operators (routing, cleaning, series, text, vectors, graph, models)
plans      composite jobs and the query catalogue used by ``__spark_entry__``
streaming  the routing job as a Structured Streaming query
"""

__version__ = "0.1.0"

# Functions shipped to Python workers (cogroup kernels, pandas UDFs) are pickled by value, so executors
# need no installed copy of this package.
try:  # pragma: no cover - depends on the PySpark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
