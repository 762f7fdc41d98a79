"""Event validation, routing, alerting and reporting on Spark DataFrames and streams."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in executors travel with their helpers, so workers need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
