"""Training-data operators: extraction, language, deduplication, mixing, tokens.

Nothing outside this subpackage imports it. Functions that run in Python
tasks travel to the executors by value, so an executor needs the third-party
libraries but no copy of this package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
