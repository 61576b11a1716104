"""Press-archive analytics on Spark: typed tables, text repair, entities, search and attention lenses."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code with them, so that nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
