"""Operators of a training-data pipeline: scans, filters, formatting, extraction, tokens, near-duplicates.

Each module holds one operator with its own general interface; ``catalog`` binds them to the tables
of a data folder. Nothing else in the package imports from here.
"""

import sys

from pyspark import cloudpickle

# Functions for tasks travel with the task: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
