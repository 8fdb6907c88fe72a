"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``broadcast(df)`` when ``df`` has at most ``max_rows`` rows, else ``df`` as is.

    The count is one job over ``df`` that sends one number per task; pass a
    stored or checkpointed frame. Beyond the bound the caller's join stays a
    shuffle join (and AQE may still pick a broadcast at run time).
    """
    return F.broadcast(df) if df.count() <= max_rows else df
