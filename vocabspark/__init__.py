"""vocabspark: build, apply, merge and audit subword vocabularies on Spark."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors with their code, so the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
