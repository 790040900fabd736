"""Event-log analytics on Spark: topics, journals, snapshots and commits as DataFrames."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: functions that tasks run are sent with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
