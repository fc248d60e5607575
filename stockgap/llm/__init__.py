"""Training-data operators: ten jobs over documents, pages and embeddings.

Nothing else in the package imports this folder.  Each module holds one
operator; ``queries.py`` holds the registered queries that apply them to the
given tables.  Functions that run in tasks are shipped by value, so executors
need the libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
