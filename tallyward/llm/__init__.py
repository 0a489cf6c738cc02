"""Operators that prepare text for language-model training.

Task functions travel to the executors by value, so that a cluster needs no installed copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
