"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
registers its queries when it can be imported.  Its functions travel to the
Python workers by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
