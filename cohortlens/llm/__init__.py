"""Training-data operators: one module per operator, queries in ``queries``, SQL in ``oracle``.

Functions that run in Python workers are shipped by value, so executors need not have this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
