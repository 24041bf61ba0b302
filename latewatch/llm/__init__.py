"""Operators for building training corpora; nothing else in the library imports this package.

Functions of this package travel to the executors with their code, so that no file of it need be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
