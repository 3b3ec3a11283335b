"""Operators for preparing training text, and their queries. Nothing else in the library imports this.

Functions that run in Python workers are pickled by value, so executors need this package's
libraries (numpy, pyarrow, xxhash, tokenizers) but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
