"""Training-data operators: sharding, dedup, PII, scoring, extraction.

Python functions of this subpackage travel to the executors by value, so the
workers need only numpy, pyarrow and the public tokenizer libraries.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
