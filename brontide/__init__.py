"""Bronze ingestion, data quality and pipeline-log processing on PySpark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers with their code, so that the package
# need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
