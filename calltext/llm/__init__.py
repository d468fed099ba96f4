"""Operators for preparing training data. Nothing else in the package imports this folder.

What tasks run of it is sent to them by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
