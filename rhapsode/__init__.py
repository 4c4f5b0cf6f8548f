"""Frame-series analytics on PySpark: operators over ragged per-frame records, as DataFrame functions."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
