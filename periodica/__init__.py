"""Spark jobs for periodic publications, and for corpora."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with the job: they need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
