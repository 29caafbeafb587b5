"""Operators of a training-data pipeline: filters, dedup, packing, sharding, tokenising, language ID.

One module per operator; ``queries.py`` holds the registered queries and their SQL.
Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
