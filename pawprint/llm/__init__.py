"""Operators of a training-data pipeline: each module holds one operator.

Nothing else in the library imports this package. Task code is pickled by
value, so executors need numpy, pyarrow and (for two operators) tokenizers,
but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
