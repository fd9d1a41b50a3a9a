"""Operators for preparing training text: filters, joins, extraction, archives and mixing.

``queries`` registers one query per operator.  Code of this package travels by value
with the tasks that use it, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
