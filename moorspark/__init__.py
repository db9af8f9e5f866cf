"""Spark-native analytics of moored-sensor time series."""

import sys

from pyspark import cloudpickle

# ship the Arrow kernels with the job, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
