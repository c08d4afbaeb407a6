"""Broadcast only behind a checked bound."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` when it provably has at most ``max_rows`` rows, else return it unchanged so the
    planner (and AQE at run time) picks a shuffle join.

    The check reads at most ``max_rows + 1`` rows of the (small) side, never the large side.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def small_table(df: DataFrame, max_rows: int) -> DataFrame:
    """A table that is small by nature (one row per model, class or run), computed once and sent as literals if it
    has at most ``max_rows`` rows; otherwise ``df`` itself, for a shuffle join. At most ``max_rows + 1`` rows reach
    the driver, and what follows knows the exact size before it plans."""
    rows = df.limit(max_rows + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= max_rows else df
