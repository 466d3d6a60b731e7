"""Review intelligence on Spark: intake, enrichment, cleaning, KPIs, exports.

Every operator is a function from DataFrame to DataFrame; nothing runs until
the caller asks for rows or writes a table.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so the executors
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
