"""Operators for training-data corpora and the queries that apply them; nothing else imports this subpackage.

Its functions travel to Python workers by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
