"""musterroll: register-style tables on Spark, queried by declared, friendly names."""

import sys

from pyspark import cloudpickle

from musterroll.plans.engine import Engine
from musterroll.specs import REGISTERS, Catalog, ColumnSpec, TableSpec

__all__ = ["Engine", "Catalog", "ColumnSpec", "TableSpec", "REGISTERS"]

# The few functions that run in Python tasks travel with the task, so that executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
