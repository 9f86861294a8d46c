"""Operators that prepare a text corpus for training a language model."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
