"""Operators of a training-data pipeline over a documents table.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own interface; :mod:`tessera.llm.queries` registers the
``opN_<name>`` queries on top of them.

Functions that run in Python workers are pickled by value, so executors need
neither this package on their path nor the driver's working directory.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
