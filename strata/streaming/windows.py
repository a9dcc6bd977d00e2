"""Watermarked tumbling-window Gold for streams.

Append mode emits a window once, after the watermark (max event time seen
minus the delay, advanced between micro-batches) passes the window's end; a
row whose window already closed is dropped and counted in the query progress
(``numRowsDroppedByWatermark``). The watermark also evicts closed windows
from the state store, so state stays bounded by the open windows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.windows import window_counts


def event_time(df: DataFrame, ts_col: str) -> DataFrame:
    """Watermarks need a session-zone timestamp; Parquet timestamps without a
    zone load as ``timestamp_ntz`` and are reinterpreted under the UTC session."""
    if dict(df.dtypes)[ts_col] == "timestamp_ntz":
        return df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    return df


def watermarked_window_counts(
    df: DataFrame,
    ts_col: str,
    keys: Sequence[str],
    size: str = "10 minutes",
    delay: str = "15 minutes",
    count_alias: str = "event_count",
) -> DataFrame:
    return window_counts(
        event_time(df, ts_col).withWatermark(ts_col, delay), ts_col, keys, size, count_alias
    )


def gold_station_windows(silver_stream: DataFrame) -> DataFrame:
    """Station events per 10-minute window, 15-minute watermark."""
    return watermarked_window_counts(
        silver_stream, "event_ts", ["station_id", "event_type"], "10 minutes", "15 minutes"
    )
