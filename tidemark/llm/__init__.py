"""Operators of a training-data pipeline: text, search, near-duplicate and packing jobs.

Nothing else in the library imports this package.  Functions that run inside tasks travel
by value, so executors need Python and the third-party packages but not this library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
