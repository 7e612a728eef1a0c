"""Sources and sinks: table adapters, file scans, exports.

Functions of this subpackage that run in tasks are pickled by value, so executors
need the third-party libraries but not the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
