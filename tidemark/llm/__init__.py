"""Operators for preparing training corpora; nothing else in the package imports this one.

Their functions travel with the tasks, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
