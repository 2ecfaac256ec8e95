"""Table, series and text operators written as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

from .session import build_session, release_scratch, scratch_dir, settle

# Functions sent to Python workers carry their code along, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "release_scratch", "scratch_dir", "settle"]
