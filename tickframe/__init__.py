"""tickframe: market-data, portfolio-risk and screening operators on Spark DataFrames.

Every operator takes and returns DataFrames and works on all symbols /
portfolios at once (keys + ordered windows, never per-symbol loops).
"""

import sys

from pyspark import cloudpickle as _cloudpickle

from tickframe.session import build_session, checkpoint_dir

# Functions handed to applyInPandas / applyInPandasWithState are pickled by value, so
# executors do not need this package installed or on their path.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "checkpoint_dir"]
