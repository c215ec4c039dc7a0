"""Analytics over order lines, written as Spark DataFrame functions.

Every operator takes DataFrames and returns DataFrames. Nothing is counted,
collected or printed inside an operator, except where an MLlib ``fit`` has to
run a job or a result of a size fixed by a parameter is turned into a model.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers as they are, so that a job
# runs from any working folder and workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
