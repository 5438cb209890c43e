"""Training-data operators: text cleaning, near-duplicates, mixing, tokens.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py``
imports it; the whole folder can be removed.
"""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors by value, so a cluster
# needs no copy of the package beside its Python.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
