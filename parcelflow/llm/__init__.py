"""Operators for preparing training data at scale, and the queries that apply them.

Functions that run inside tasks travel with the task, so executors need no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
