"""ledgerlens: customer-level risk analytics on transaction tables, written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# functions sent to Python workers travel with their code, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
