"""Operators for training-data pipelines (search, tokens, near-duplicates, mixing, classifiers).

Nothing else in the library imports this subpackage. Its functions are shipped
to the Python workers by value, so executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
