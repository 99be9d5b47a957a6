"""Event-stream analytics as Spark jobs: the same operators on bounded tables and live streams."""

import sys

from pyspark import cloudpickle

# Python workers need not have this package installed: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
