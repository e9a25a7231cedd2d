"""leafmill: documents and transcripts to searchable, cited tables, on Spark.

Every operator is a function from DataFrame to DataFrame. Nothing runs until an
action does, except where a docstring says that a table is staged or rows are read:
ranking, indexes, vector cells, positions in a group, refreshes and merges do so while
their result is being built.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in tasks travel by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
