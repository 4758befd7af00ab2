"""Operators for preparing training text: filters, scoring, de-duplication, mixing.

Nothing outside this subpackage imports it, except ``__spark_entry__`` (only
if it is there) and ``corpus_pipeline``. The functions that run inside Python
workers are pickled by value, so executors need no copy of the package.
"""

from pyspark import cloudpickle as _cloudpickle

import sys as _sys

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
