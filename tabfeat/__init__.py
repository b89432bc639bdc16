"""Feature preparation and regression evaluation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from tabfeat.spec import FeatureSpec, nan_to_null

# Ship this package's functions with the tasks, so that executors need no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["FeatureSpec", "nan_to_null"]
