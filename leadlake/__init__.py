"""Lead and price flows, and text preparation, as Spark jobs over tables.

Functions that run in Python workers are sent along with each job, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
