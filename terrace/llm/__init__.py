"""Operations of a training-data pipeline over the corpus tables.

One module per operator; ``queries`` registers the ``opN_*`` queries.  Nothing
outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need only the
# libraries, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
