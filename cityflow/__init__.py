"""cityflow: context notifications to analysis-ready tables, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from cityflow.config import FlowConfig, GraphConfig, configure, work_dir

__all__ = ["FlowConfig", "GraphConfig", "configure", "work_dir"]

# The few Arrow functions travel with their plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
