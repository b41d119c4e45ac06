"""Case-hotspot analytics on Spark.

Functions of this package travel to the executors by value, so these need not
have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
