"""Bundled queries of the text-first stream: fields that nobody knew, late rows
that correct their windows. With their oracle SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.bundled import load
from strata.plans.bundled_io import EVENT_HINTS, LATE_TYPE, STATE_PARTITIONS
from strata.plans.bundled_sql import ORACLE_SQL
from strata.session import scratch_path
from strata.streaming.lines import KnownFields, gold_windows, lines_pass, read_lines
from strata.streaming.sinks import TwoHopPaths
from strata.streaming.sources import RESCUED_COL

_ARGS = dict(ts_col="ts", keys=["event_type"], required=["event_id", "ts"], hints_ddl=EVENT_HINTS, state_partitions=STATE_PARTITIONS)


def _paths(spark: SparkSession, name: str) -> TwoHopPaths:
    base = scratch_path(spark, name)
    return TwoHopPaths(f"{base}/landing", f"{base}/bronze", f"{base}/gold", f"{base}/_checkpoints")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time as text, the way lines carry it."""
    return load(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type", "value"
    )


def stream_text_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after three passes. Clicks come in the second and third and have
    a field that no hint names: the second pass meets it unknown, the third has
    it as a column. Some have a bad time, some are cut-off lines."""
    paths = _paths(spark, "text_first")
    events = _events(spark, sf_dir)
    late = F.col("event_type") == LATE_TYPE
    events.where(~late).write.mode("append").json(paths.landing)
    lines_pass(spark, paths, **_ARGS)
    drifted = events.where(late).withColumns(
        {"ts": F.when(F.col("value") >= 350, F.lit("noon")).otherwise(F.col("ts")), "bike": F.lit("new")}
    )
    line = F.to_json(F.struct("*"))
    cut = F.when(F.col("value") < 50, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    even = F.col("event_id") % 2 == 0
    for part in (even, ~even):
        drifted.where(part).select(cut.alias("value")).write.mode("append").text(paths.landing)
        lines_pass(spark, paths, **_ARGS)
    bronze = read_lines(spark, paths.bronze, KnownFields(spark, paths.schema_location).schema())
    if "bike" not in bronze.columns:  # a table without clicks
        bronze = bronze.withColumn("bike", F.lit(None).cast("string"))
    kept_text = F.regexp_extract(RESCUED_COL, '"event_id":([0-9]+)', 1).try_cast("bigint")
    return bronze.select(
        F.coalesce("event_id", kept_text).alias("event_id"), "event_type", "bike",
        F.col("ts").cast("timestamp_ntz").alias("ts"), F.col(RESCUED_COL).isNotNull().alias("rescued"),
    )


def windows_stream_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two passes, of which the second brings all clicks, most of them behind
    the watermark: closed windows with the late rows counted in are what a batch
    over all events counts."""
    paths = _paths(spark, "corrected")
    late_path = f"{paths.gold}_late"
    events = _events(spark, sf_dir)
    late = F.col("event_type") == LATE_TYPE
    for part in (~late, late):
        events.where(part).write.mode("append").json(paths.landing)
        lines_pass(spark, paths, **_ARGS, late_path=late_path)
    windows = gold_windows(spark, paths, "ts", ["event_type"], EVENT_HINTS, late_path=late_path)
    return windows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


LINES_QUERIES = {"stream_text_first": stream_text_first, "windows_stream_corrected": windows_stream_corrected}

LINES_SQL = {
    "stream_text_first": ORACLE_SQL["stream_schema_drift"],
    "windows_stream_corrected": ORACLE_SQL["windows_stream"],
}
