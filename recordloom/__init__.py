"""PySpark-native building and preparation of instruction datasets."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
