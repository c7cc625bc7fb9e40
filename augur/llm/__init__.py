"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage. Each module is one
operator with its thin registered query; ``queries.py`` lists the queries and
``oracle.py`` their SQL.
"""

import sys

from pyspark import cloudpickle

# Functions that run in executors travel with the job, so a cluster needs no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
