"""lumenkg: a Spark-native engine that turns publication tables into a
scored, deduplicated article table and a knowledge graph."""
import sys as _sys

try:  # ship this package's UDF code with the task instead of importing it on executors
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

__version__ = "0.1.0"
