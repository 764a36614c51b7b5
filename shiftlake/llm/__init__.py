"""Operators of a training-data pipeline: filters, deduplication, packing and output.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Workers need not have the package installed: its functions travel with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
