"""Account-behaviour analytics on Spark: features, outlier models, reports, streams."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers carry their code, so executors need no copy
# of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
