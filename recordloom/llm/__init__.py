"""Operators for training data: mixing, token files, deduplication, packing, filters.

Functions that run inside tasks travel by value, so executors need no installed copy of this
package. Nothing outside this folder imports it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
