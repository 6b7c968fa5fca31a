"""Broadcast only what has a checked size.

A side is broadcast when its row count is known to be under ``max_rows``:
either from a bound the caller proves (a cap times the number of networks, the
days of the requests), or from an exact count of an already small frame.
Above the bound the join is left to the shuffle strategies (sort-merge with
AQE skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a broadcast side may have: a few narrow columns each, so a few hundred MB at most.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000


def size_checked_broadcast(df: DataFrame, known_rows: int | None = None,
                           max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                           count_if_unknown: bool = True) -> DataFrame:
    """Return ``broadcast(df)`` when its size is proven small, else ``df``.

    ``known_rows`` is an upper bound the caller can prove.  Without one the
    frame is counted (``count_if_unknown``), which is only sensible for frames
    that are themselves small aggregates or already materialised.
    """
    rows = known_rows
    if rows is None and count_if_unknown:
        rows = df.count()
    if rows is not None and rows <= max_rows:
        return F.broadcast(df)
    return df
