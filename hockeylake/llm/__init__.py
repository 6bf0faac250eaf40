"""Operators for preparing language-model training data on Spark.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
