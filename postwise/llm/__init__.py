"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Its functions that run inside tasks are sent to the executors by value, so the
package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
