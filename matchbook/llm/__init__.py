"""Training-data operators: each module is one operator; ``queries`` binds them to the given tables.

Code that runs in Python workers is pickled with its tasks, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
