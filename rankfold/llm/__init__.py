"""Training-data operators: filtering, deduplication, language, personal data, mixing, packing.

Nothing outside this package imports it; its queries are in ``queries`` and its SQL in ``oracle``.
Functions that run in tasks are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
