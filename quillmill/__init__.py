"""A Spark-native engine for text verification, publishing state and corpus curation.

Functions that run on executors travel with the job by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
