"""Security scanning of source code collections as Spark jobs."""

import sys

from pyspark import cloudpickle

# Python workers of a cluster need not have this package installed: the few helper
# functions that run inside tasks travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
