"""Operators of a large-scale training-data pipeline, one module each.

Nothing outside this package imports it; ``queries.py`` registers one query
per operator.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors inside the job, so a
# cluster needs no copy of the package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
