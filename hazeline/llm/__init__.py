"""Operators of a training-data pipeline. Nothing else in the library imports this folder.

Functions of this folder travel to the executors with their tasks, so a session
needs no copy of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
