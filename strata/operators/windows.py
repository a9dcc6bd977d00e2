"""Tumbling event-time windows, shared by the batch and the streaming Gold.

The batch form is a plain hash aggregate keyed by the window start; the
streaming form (``strata.streaming.windows``) adds the watermark that bounds
state and decides lateness.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(
    df: DataFrame,
    ts_col: str,
    keys: Sequence[str],
    size: str = "10 minutes",
    count_alias: str = "event_count",
) -> DataFrame:
    """``count(*)`` per (tumbling window of ``size``, keys), flattened to
    ``window_start, window_end, *keys, count_alias``."""
    return (
        df.groupBy(F.window(F.col(ts_col), size).alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias(count_alias))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            count_alias,
        )
    )
