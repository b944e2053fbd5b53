"""Broadcasts whose size a statement itself bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sides of at most this many rows are broadcast. A limit, an offset or a k of the caller bounds them, whatever the size
# of the tables; beyond it they are joined like any other side.
BROADCAST_ROWS = 100_000


def few(side: DataFrame, rows: int) -> DataFrame:
    """A side of at most ``rows`` rows, broadcast if that is few: the other side then needs no shuffle."""
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side
