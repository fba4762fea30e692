"""Operators of a training-data pipeline over text corpora.

Functions that run in Python workers are shipped by value, so executors need no
installed copy of this package.
"""

import tidemark
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(tidemark)
