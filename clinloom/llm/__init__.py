"""Operators for training-data corpora, one module per operator.

The functions that run in tasks are shipped with the job, so executors need no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
