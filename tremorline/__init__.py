"""Signal telemetry analytics expressed as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
