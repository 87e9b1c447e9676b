"""Operators for training data: text, labels, pages and vectors."""

import sys

from pyspark import cloudpickle

# Functions run by executors travel with the job, so that nothing has to be
# installed there but the public libraries.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
