"""lodestone: staged data and model pipelines written on the Spark DataFrame API.

Every public operator is a plain function that takes and returns DataFrames
(or Columns), so they chain with ``df.transform``.  No operator collects data
rows to the driver; the only driver-side values are bounded ones (label lists,
parameter grids, histogram counts of a fixed bucket count, metrics).
"""

import sys

from lodestone.session import get_session, shared_dir, scratch_path, read_table

# Functions of this package that end up inside Python UDFs (the pandas
# scorer) are shipped by value, so executors need not have the package
# installed or on their path.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to by-reference
    pass

__all__ = ["get_session", "shared_dir", "scratch_path", "read_table"]
