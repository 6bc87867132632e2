"""Operators for preparing training text.

Columns whose names start with an underscore are working columns: an input column with the same name is replaced and
dropped.

Executor code of this package is shipped by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
