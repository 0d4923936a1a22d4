"""Training-data operators: one module per operator, and their queries.

Nothing else in the library imports this subpackage; it stands on its own.
Functions that run inside tasks are sent by value, so executors need not have
the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
