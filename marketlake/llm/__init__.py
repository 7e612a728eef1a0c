"""Operators of a training-data pipeline: search, decontamination, scans, dedup, packing, sharding.

Nothing outside this subpackage imports it (``__spark_entry__.py`` adds its
queries only where it is present). Functions that run in tasks are pickled by
value, so executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
