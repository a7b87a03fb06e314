"""Operators for training-data corpora: deduplication, filtering, mixing, formatting, sharding.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
when the folder is there.
"""

import sys

from pyspark import cloudpickle

# Functions that run on executors are sent whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
