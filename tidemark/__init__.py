"""A PySpark engine for content recommendation and corpora.

Functions that run in Python workers are shipped by value, so that executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
