"""Checked queries: every operator applied to the sample tables.

Each entry pairs a Spark query with the SQL that must give the same rows, where
SQL can express it.
"""

from musterroll.workload.base import CHECKS, Check
from musterroll.workload import (  # noqa: F401  (imported for their checks)
    cleaning,
    files,
    filters,
    joins,
    reshaping,
    searching,
    snapshots,
    summaries,
)

__all__ = ["CHECKS", "Check"]
