"""Operators for building language-model training data.

Nothing outside this subpackage imports it. Every operator takes and returns
DataFrames; ``queries.py`` registers one query per operator.
"""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the executors by value, so the
# package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
