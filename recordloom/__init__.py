"""Golden-record integration and data quality as PySpark DataFrame operators.

Python functions of the package travel to executors by value, so they need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
