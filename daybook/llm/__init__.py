"""Operators for preparing training data; nothing else in the library imports this package.

Functions of this package that run inside tasks travel to the workers by value, so the package is
needed on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
