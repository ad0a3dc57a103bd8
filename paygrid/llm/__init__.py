"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  Task-side helpers are
pickled by value, so executors need numpy, pandas and pyarrow but no copy of
this code.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
