"""Joins with tables whose size is checked before it is relied on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of two or three numbers that are broadcast at most, about 48 MB.
BROADCAST_ROWS = 2_000_000


def small_side(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` with a broadcast hint if it has few rows; otherwise as it is, for a shuffled join of the same result."""
    few = table.limit(rows + 1).count() <= rows
    return F.broadcast(table) if few else table
