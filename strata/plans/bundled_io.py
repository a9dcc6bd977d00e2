"""Bundled queries that go through storage: landing, slice replacement,
schema evolution, incremental reads, paging and the two-hop stream.

Each call writes under a fresh folder below the session's checkpoint root
(shared storage on a cluster) and returns a DataFrame over what was written
or read back, computed from the whole input table.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.bundled import load
from strata.session import scratch_path
from strata.sources.incremental import (
    HighWaterMarks,
    assign_pages,
    cursor_max,
    date_window,
    keyset_page,
    load_date_window,
    page_by_number,
    read_date_window,
    read_since,
)
from strata.sources.landing import ingest_bronze, land_batch, slice_path
from strata.sources.tables import (
    load_table_slices,
    read_slices,
    replace_slice,
    replace_table_slice,
    write_slices,
)
from strata.streaming.sinks import TwoHopPaths, stream_pass
from strata.streaming.sources import RESCUED_COL

# Fixed parameters (the oracle SQL uses the same values).
CURSOR_HWM = "1999-06-30 00:00:00"
WINDOW_HWM = "1997-06-01"
WINDOW_TODAY = "1998-01-03"
PAGE_SIZE = 1000
PAGE_NUMBER = 3
KEYSET_AFTER = ("1998-01-01 00:00:00", 0)
LATE_TYPE = "click"
STATE_PARTITIONS = 8
EVENT_HINTS = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE"


def _orders_bronze_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as string fields, the way an API would deliver them."""
    o = load(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"),
    )


def landing_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land orders as JSON lines, ingest the arrival date into Bronze twice
    (the rerun replaces), read the Bronze table back."""
    root = scratch_path(spark, "landing")
    bronze = scratch_path(spark, "bronze_orders")
    land_batch(_orders_bronze_feed(spark, sf_dir), root, "orders", "2024-01-01", "b0001")
    ingest_bronze(spark, root, "orders", bronze, "2024-01-01")
    ingest_bronze(spark, root, "orders", bronze, "2024-01-01")
    # each row names the landed file it came from (the folder is per run)
    own_file = F.col("_source_file").rlike(
        r"/orders/ingest_date=2024-01-01/batch_id=b0001/part-[^/]+\.json$"
    )
    return read_slices(spark, bronze).select(
        "*", own_file.alias("from_landed_file")
    ).drop("_ingested_at", "_source_file")


def landing_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers landed as files of one JSON array spread over lines (at most
    1,000 records each, as a paged API delivers them), ingested into Bronze."""
    root, bronze = scratch_path(spark, "landing_arrays"), scratch_path(spark, "bronze_suppliers")
    s = load(spark, sf_dir, "supplier")
    chunk = F.concat_ws("-", "s_nationkey", F.floor(F.col("s_suppkey") / 1000))
    records = F.collect_list(F.struct("s_suppkey", "s_name", "s_nationkey"))
    arrays = s.groupBy(chunk.alias("batch_id")).agg(records.alias("records"))
    arrays = arrays.select("batch_id", F.to_json("records", {"pretty": "true"}).alias("value"))
    arrays.write.partitionBy("batch_id").text(slice_path(root, "suppliers", "2024-01-01"))
    ingest_bronze(spark, root, "suppliers", bronze, "2024-01-01", multi_line=True)
    return read_slices(spark, bronze).select("s_suppkey", "s_name", "s_nationkey", "batch_id", "_ingest_date")


def _year_slice() -> F.Column:
    return F.concat(F.year("o_orderdate").cast("string"), F.lit("-01-01"))


def replace_slice_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slice orders by order year; replace 1997 with its fulfilled orders
    only and 1998 with nothing; read back."""
    path = scratch_path(spark, "sliced_orders")
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", _year_slice().alias("_ingest_date")
    )
    write_slices(o, path, "_ingest_date")
    redo = o.filter((F.col("_ingest_date") == "1997-01-01") & (F.col("o_orderstatus") == "F"))
    replace_slice(redo.drop("_ingest_date"), path, "_ingest_date", "1997-01-01")
    replace_slice(redo.drop("_ingest_date"), path, "_ingest_date", "1997-01-01")  # rerun
    replace_slice(o.filter(F.lit(False)).drop("_ingest_date"), path, "_ingest_date", "1998-01-01")
    return read_slices(spark, path)


def replace_slice_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``replace_slice`` on a catalog table: one bulk load of every year's
    slice, then 1997 replaced by its fulfilled orders and 1998 by nothing,
    each as a single partition repoint."""
    db = "strata_bronze"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{scratch_path(spark, db)}'")
    table = f"{db}.orders_{uuid.uuid4().hex[:12]}"
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", _year_slice().alias("_ingest_date")
    )
    load_table_slices(spark, o, table, "_ingest_date")
    redo = o.filter((F.col("_ingest_date") == "1997-01-01") & (F.col("o_orderstatus") == "F"))
    replace_table_slice(spark, redo, table, "_ingest_date", "1997-01-01")
    replace_table_slice(spark, o.filter(F.lit(False)), table, "_ingest_date", "1998-01-01")
    return spark.table(table)


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices up to 1997 carry three fields; later slices add a fourth.
    Reading merges the schemas: early rows read NULL for the new field."""
    path = scratch_path(spark, "evolving_orders")
    feed = _orders_bronze_feed(spark, sf_dir).withColumn(
        "_ingest_date", F.concat(F.substring("o_orderdate", 1, 4), F.lit("-01-01"))
    )
    early = feed.filter(F.col("_ingest_date") <= "1997-01-01").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "_ingest_date"
    )
    late = feed.filter(F.col("_ingest_date") > "1997-01-01").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "_ingest_date"
    )
    write_slices(early, path, "_ingest_date")
    write_slices(late, path, "_ingest_date")
    return read_slices(spark, path)


def incremental_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows strictly after the stored cursor."""
    marks = HighWaterMarks(spark, scratch_path(spark, "hwm"))
    marks.set("orders", CURSOR_HWM)
    hwm = marks.get("orders", "1900-01-01 00:00:00")
    return read_since(load(spark, sf_dir, "orders"), "o_orderdate", hwm)


def incremental_hwm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark after the cursor read: the greatest cursor value received."""
    new_rows = read_since(load(spark, sf_dir, "orders"), "o_orderdate", CURSOR_HWM)
    return cursor_max(new_rows, "o_orderdate")


def incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date window ``[hwm, today - 2]`` inclusive."""
    start, end = date_window(WINDOW_HWM, WINDOW_TODAY, lag_days=2)
    return read_date_window(load(spark, sf_dir, "orders"), "o_orderdate", start, end)


def incremental_window_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date window landed and read back, with the mark its landing left."""
    marks, path = HighWaterMarks(spark, scratch_path(spark, "marks")), scratch_path(spark, "window")
    marks.set("orders", WINDOW_HWM)
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    load_date_window(o, "o_orderdate", marks, "orders", WINDOW_HWM, WINDOW_TODAY, land=lambda rows: rows.write.parquet(path))
    return spark.read.parquet(path).withColumn("mark", F.lit(marks.get("orders", WINDOW_HWM)))


def paged_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its position and page in (orderdate, orderkey) order."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    return assign_pages(o, ["o_orderdate", "o_orderkey"], PAGE_SIZE)


def page_by_number_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page ``PAGE_NUMBER`` of the orders in (orderdate, orderkey) order."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    return page_by_number(o, ["o_orderdate", "o_orderkey"], PAGE_SIZE, PAGE_NUMBER)


def keyset_page_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page that follows key ``KEYSET_AFTER`` (a page of ``PAGE_SIZE`` rows)."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    after = (F.lit(KEYSET_AFTER[0]).cast("timestamp_ntz"), KEYSET_AFTER[1])
    return keyset_page(o, ["o_orderdate", "o_orderkey"], PAGE_SIZE, after=after)


def windows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON lines, streamed into Bronze, then into 10-minute
    windows per event type with a 15-minute watermark (one drain pass)."""
    base = scratch_path(spark, "stream")
    paths = TwoHopPaths(f"{base}/landing", f"{base}/bronze", f"{base}/gold", f"{base}/_checkpoints")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    events.write.mode("overwrite").option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ).json(paths.landing)
    stream_pass(
        spark, paths, ts_col="ts", keys=["event_type"], required=["event_id", "ts"],
        hints_ddl=EVENT_HINTS, state_partitions=STATE_PARTITIONS,
    )
    gold = spark.read.parquet(paths.gold)
    return gold.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "event_type",
        "event_count",
    )


def windows_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scheduled passes over one landing folder: every event except
    clicks lands first; the clicks land before the second pass, behind the
    watermark the first pass left in the checkpoint. Clicks whose window had
    closed by then are dropped; the rest are counted."""
    base = scratch_path(spark, "stream_late")
    paths = TwoHopPaths(f"{base}/landing", f"{base}/bronze", f"{base}/gold", f"{base}/_checkpoints")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    args = dict(ts_col="ts", keys=["event_type"], required=["event_id", "ts"], hints_ddl=EVENT_HINTS, state_partitions=STATE_PARTITIONS)
    late = F.col("event_type") == LATE_TYPE
    events.filter(~late).write.mode("append").option("timestampNTZFormat", fmt).json(paths.landing)
    stream_pass(spark, paths, **args)
    events.filter(late).write.mode("append").option("timestampNTZFormat", fmt).json(paths.landing)
    stream_pass(spark, paths, **args)
    gold = spark.read.parquet(paths.gold)
    return gold.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "event_type",
        "event_count",
    )


def stream_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after two passes of the stream. The second pass's events, clicks,
    have a new field; some have a bad time and some are cut-off lines, whose
    text Bronze keeps."""
    base = scratch_path(spark, "stream_drift")
    paths = TwoHopPaths(f"{base}/landing", f"{base}/bronze", f"{base}/gold", f"{base}/_checkpoints")
    args = dict(ts_col="ts", keys=["event_type"], required=["event_id", "ts"], hints_ddl=EVENT_HINTS, state_partitions=STATE_PARTITIONS)
    events = load(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type", "value"
    )
    late = F.col("event_type") == LATE_TYPE
    events.filter(~late).write.mode("append").json(paths.landing)
    stream_pass(spark, paths, **args)
    drifted = events.filter(late).withColumns(
        {"ts": F.when(F.col("value") >= 350, F.lit("noon")).otherwise(F.col("ts")), "bike": F.lit("new")}
    )
    line = F.to_json(F.struct("*"))
    cut = F.when(F.col("value") < 50, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)
    drifted.select(cut.alias("value")).write.mode("append").text(paths.landing)
    stream_pass(spark, paths, **args)
    bronze = spark.read.option("mergeSchema", "true").parquet(paths.bronze)
    kept_text = F.regexp_extract(RESCUED_COL, '"event_id":([0-9]+)', 1).cast("bigint")
    return bronze.select(
        F.coalesce("event_id", kept_text).alias("event_id"), "event_type", "bike",
        F.col("ts").cast("timestamp_ntz").alias("ts"), F.col(RESCUED_COL).isNotNull().alias("rescued"),
    )


IO_QUERIES = {
    "landing_bronze": landing_bronze,
    "landing_arrays": landing_arrays,
    "incremental_window_load": incremental_window_load,
    "stream_schema_drift": stream_schema_drift,
    "replace_slice": replace_slice_query,
    "replace_slice_table": replace_slice_table,
    "schema_evolution": schema_evolution,
    "incremental_cursor": incremental_cursor,
    "incremental_hwm": incremental_hwm,
    "incremental_window": incremental_window,
    "paged_read": paged_read,
    "keyset_page": keyset_page_query,
    "page_by_number": page_by_number_query,
    "windows_stream": windows_stream,
    "windows_stream_late": windows_stream_late,
}
