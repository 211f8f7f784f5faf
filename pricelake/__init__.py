"""pricelake: retail price-collection jobs expressed as Spark DataFrame plans.

Page snapshots, JSON payloads and category targets go in; deduplicated,
normalised daily product rows come out, and single days of a
date-partitioned table are replaced in batch or by Structured Streaming.
"""

import sys as _sys

# Functions this package hands to Python workers (the page job) are pickled
# by value, so workers need not have the package installed or on their path.
from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from pricelake.session import get_spark, checkpoint_dir  # noqa: E402

__all__ = ["get_spark", "checkpoint_dir"]
