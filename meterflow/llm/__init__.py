"""Training-data operators: scans, scores, joins and mixing over large text tables.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the executors whole, which then need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
