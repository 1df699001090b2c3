"""tokenloom: corpus preparation and training-run analytics as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Task-side helpers travel inside the pickled closure, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
