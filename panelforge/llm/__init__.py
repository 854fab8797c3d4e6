"""Corpus operators for training data: thirteen operators, their queries and SQL twins.

Functions that run in Python workers travel by value, so executors need no
installed copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
