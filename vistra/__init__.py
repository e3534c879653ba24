"""vistra: visit analytics expressed as Spark DataFrame plans.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects
(or builds them from a ``SparkSession``); nothing is collected to the driver
except bounded, already-aggregated results.
"""

import sys as _sys

try:
    # The few Python functions shipped to executors (mapInPandas) are pickled
    # by value, so workers need not have this package on their path.
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: ship with --py-files
    pass

__all__ = ["session", "schema", "fixtures"]
