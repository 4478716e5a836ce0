"""Operators of a training-data pipeline; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so that a job needs no
# copy of the package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
