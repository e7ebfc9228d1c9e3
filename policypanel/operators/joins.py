"""Join helpers with an explicit broadcast policy.

A broadcast hint is given only behind a proven bound on the small side:

* the relation already sits in driver memory (an inline literal table), or
* the caller proves it by construction (top-k output, the two-row era table).

Otherwise no hint is given and Spark decides with its own size check: the planner
broadcasts a side whose estimated size is below ``spark.sql.autoBroadcastJoinThreshold``
and otherwise plans a sort-merge join, and AQE re-checks the *materialised* size of
each shuffle stage (``spark.sql.adaptive.autoBroadcastJoinThreshold``) before the
join runs. Base-table dimensions (nation, part, supplier) and aggregates of large
tables go through that path, so nothing grows past the threshold unchecked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def is_driver_local(df: DataFrame) -> bool:
    """True for relations held on the driver (``createDataFrame`` of a list)."""
    try:
        return bool(df.isLocal())
    except Exception:  # pragma: no cover - very old PySpark
        return False


def join_small(left: DataFrame, right: DataFrame, on: str | Sequence[str],
               how: str = "left", proven_small: bool = False) -> DataFrame:
    """Equi-join to a dimension. The hint is added only for a driver-local right
    side or when the caller proves the bound (``proven_small``)."""
    if proven_small or is_driver_local(right):
        right = F.broadcast(right)
    return left.join(right, on, how)
