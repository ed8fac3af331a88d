"""Operators for large text corpora (quality, near duplicates, packing, mixing, scans, sharding, HTML, chat).

Functions of this subpackage that run on executors travel by value, so a
cluster needs no copy of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
