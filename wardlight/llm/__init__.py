"""Operators for preparing training text at scale.

The code that runs inside tasks is shipped by value, so that executors need no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
