"""Column expressions, built-in functions that run inside the JVM, and helpers for use in tasks."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
