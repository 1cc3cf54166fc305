"""Operators of a training-data pipeline; nothing else in the library imports them.

Functions that run in tasks travel with them, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
