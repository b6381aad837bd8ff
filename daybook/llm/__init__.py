"""Training-data operators: sharding, search, mixing, archives, filtering, dedup, tokens, toxicity.

Nothing outside this subpackage imports it. Every operator takes DataFrames, selects only the columns
it names (so extra columns, also ones whose names clash with its results, never matter) and cuts
lineage only through tables in the shared folder of ``spark.checkpoint.dir``.
"""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the task, so the executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
