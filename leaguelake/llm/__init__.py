"""Operators for preparing text for language-model training. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors whole, so a cluster needs no installed copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
