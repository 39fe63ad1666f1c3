"""Training-data operators: the ten corpus operators and the pipeline's stages.

Each operator has a module of its own with a general interface (DataFrame in,
DataFrame out, parameters as arguments); :mod:`gocledger.llm.queries` holds the
thin ``opN_<name>`` queries over the given tables.  Nothing else in the library
imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with their code, so executors need not
# have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
