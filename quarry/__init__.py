"""quarry: Spark-native analytics jobs.

Every operator takes DataFrames and returns a DataFrame. Work is declared with
the DataFrame API so Catalyst and AQE choose the physical plan; Python runs only
where a built-in expression cannot state the rule (stemming a distinct
vocabulary, the k-means update inside Arrow batches).
"""

import sys as _sys

# Functions of this package that run in Python workers (pandas UDF,
# mapInPandas) are shipped by value, so executors need not have the package
# installed or on their path.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark without the hook
    pass

__all__ = ["session"]
