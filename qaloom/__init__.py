"""qaloom: question-answer dataset work as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Python steps travel to executors with their code, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
