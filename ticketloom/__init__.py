"""Ticket analytics on Spark: every operator takes DataFrames and returns a DataFrame."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions used inside tasks travel with them, so the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
