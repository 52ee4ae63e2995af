"""Training-data operators (token output, mixing, dedup, classifiers, search).

Nothing outside this folder imports it; `__spark_entry__.py` adds its queries
when the folder is there.  Queries and their SQL are in `queries.py`.
"""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors by value, so the executors need
# no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
