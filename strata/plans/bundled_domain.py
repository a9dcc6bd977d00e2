"""The weather, crimes and station pipelines, run over the bundled tables.

The domain functions expect API-shaped raw feeds; these queries derive such
feeds from whole tables (one hourly payload document per lineitem, one
crime update per order, one station event per event row) and run the
pipelines unchanged on them.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.flatten import flatten_columnar
from strata.operators.lineage import stamp_slice
from strata.operators.quality import (
    FAILURES_COL,
    expect_not_null,
    run_suite,
    tag_failures,
)
from strata.plans.bundled import load
from strata.plans.crimes import (
    crimes_weather_daily,
    gold_crimes_daily,
    iucr_updates,
    scd2_upsert_iucr,
    silver_crimes,
)
from strata.plans.medallion import (
    GoldTables,
    crimes_checks,
    gold_step,
    silver_step,
    station_stream_pass,
    weather_checks,
)
from strata.plans.weather import flatten_hourly, gold_daily_weather, silver_weather
from strata.session import scratch_path
from strata.sources.versions import overwrite_table
from strata.streaming.sinks import TwoHopPaths

FEED_DATE = "2024-01-01"
IUCR_FIRST_LOAD = "1998-01-01"
IUCR_SECOND_LOAD = "2002-01-01"


def _pad(c: Column | str, width: int) -> Column:
    """Zero-padded to ``width``; a longer value keeps all its characters."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), "0")


def _day(c: str) -> Column:
    return F.col(c).cast("date").cast("string")


# -- weather ----------------------------------------------------------------

def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hourly payload per lineitem: ``l_linenumber`` hours of its ship
    date; precipitation is one value short (the last hour reads NULL)."""
    return payloads_of(load(spark, sf_dir, "lineitem"))


def payloads_of(li: DataFrame) -> DataFrame:
    n, q = F.col("l_linenumber"), F.col("l_quantity")

    def hourly(value, length=n) -> Column:
        return F.slice(F.transform(F.sequence(F.lit(0), n - 1), value), 1, length)

    city = (
        F.when(F.col("l_returnflag") == "R", "chicago")
        .when(F.col("l_returnflag") == "A", "new_york")
        .otherwise("seattle")
    )
    day = _day("l_shipdate")
    return li.select(
        city.alias("city"),
        F.concat_ws(
            "-", F.lit("weather"), day, _pad("l_orderkey", 10),
            _pad("l_partkey", 8), _pad("l_suppkey", 6), n.cast("string"),
        ).alias("_source_file"),
        F.struct(
            hourly(lambda h: F.concat(day, F.lit("T"), _pad(h, 2), F.lit(":00"))).alias("time"),
            hourly(lambda h: F.when(q > 48, F.lit(999.0)).otherwise(q - 20 + h)).alias("temperature_2m"),
            hourly(lambda h: F.round(F.col("l_tax") * 1000) + h * 10).alias("relative_humidity_2m"),
            hourly(lambda h: F.col("l_discount"), n - 1).alias("precipitation"),
            hourly(lambda h: q + h).alias("wind_speed_10m"),
        ).alias("hourly"),
    )


def _weather_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened payloads as text, stamped; each row keeps its document's file."""
    payloads = weather_payloads(spark, sf_dir)
    flat = flatten_columnar(payloads, "hourly", index_field="time", keep=["city", "_source_file"],
                            index_alias="observed_at")
    measures = ["temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m"]
    raw = flat.select(
        "city", "observed_at", "_source_file",
        *[F.col(m).cast("string").alias(m) for m in measures],
    )
    return stamp_slice(raw, "weather", FEED_DATE)


def _weather_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_weather(_weather_bronze(spark, sf_dir))


def weather_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _weather_silver(spark, sf_dir)
    return s.drop("_ingested_at").withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz"))


def weather_gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_daily_weather(_weather_silver(spark, sf_dir))


def weather_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_hourly(weather_payloads(spark, sf_dir).select("city", "hourly"))


# -- crimes -----------------------------------------------------------------

def crimes_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One crime update per order: the customer is the case (several
    updates per case, mixed-case numbers), the order date the update time."""
    o = load(spark, sf_dir, "orders")
    day = _day("o_orderdate")
    raw = o.select(
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("hy"), F.col("o_custkey").cast("string")))
        .otherwise(F.concat(F.lit("HY"), F.col("o_custkey").cast("string"))).alias("case_number"),
        F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), F.lit("unknown"))
        .otherwise(F.concat(day, F.lit("T10:00"))).alias("date"),
        F.concat(day, F.lit("T00:00")).alias("updated_on"),
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("primary_type"),
        F.when(F.col("o_orderstatus") == "F", "true").when(F.col("o_orderstatus") == "O", "false")
        .otherwise("maybe").alias("arrest"),
        F.when(F.col("o_totalprice") > 250000, "true").otherwise("false").alias("domestic"),
        F.concat(F.lit("41."), _pad(F.col("o_orderkey") % 1000, 3)).alias("latitude"),
        F.concat(F.lit("-87."), _pad(F.col("o_custkey") % 1000, 3)).alias("longitude"),
        _pad(F.col("o_custkey") % 40, 4).alias("iucr"),
        F.concat_ws(" / ", "o_orderpriority", "o_orderstatus").alias("description"),
        F.concat(F.lit("crimes-"), _pad("o_orderkey", 10)).alias("_source_file"),
    )
    return stamp_slice(raw, "crimes", FEED_DATE)


def _crimes_split(spark: SparkSession, sf_dir: str):
    silver = silver_crimes(crimes_bronze(spark, sf_dir))
    return silver, expect_not_null("case_number", "occurred_at")


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def crimes_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, _ = _crimes_split(spark, sf_dir)
    return _ntz(silver.drop("_ingested_at"), "occurred_at", "updated_on")


def _crimes_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, check = _crimes_split(spark, sf_dir)
    return tag_failures(silver, [check]).filter(F.size(FAILURES_COL) == 0).drop(FAILURES_COL)


def crimes_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, check = _crimes_split(spark, sf_dir)
    _, quarantine, _ = run_suite(silver, [check])
    out = quarantine.withColumn("dq_reasons", F.array_join(FAILURES_COL, "|")).drop(FAILURES_COL)
    return _ntz(out.drop("_ingested_at"), "occurred_at", "updated_on")


def crimes_gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_crimes_daily(_crimes_good(spark, sf_dir))


def crimes_weather_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crimes_weather_daily(
        gold_crimes_daily(_crimes_good(spark, sf_dir)),
        gold_daily_weather(_weather_silver(spark, sf_dir)),
    )


def iucr_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IUCR code dimension: first load from cases before 1998, then the
    whole feed as the next update, each published as a table version."""
    good = _crimes_good(spark, sf_dir)
    db = _scratch_db(spark, "strata_dims")
    table = f"{db}.dim_iucr_{uuid.uuid4().hex[:12]}"
    root = scratch_path(spark, "dims")
    first = good.filter(F.col("occurred_date") < F.lit(IUCR_FIRST_LOAD).cast("date"))
    scd2_upsert_iucr(spark, iucr_updates(first, f"{IUCR_FIRST_LOAD} 00:00:00"), table, root)
    scd2_upsert_iucr(spark, iucr_updates(good, f"{IUCR_SECOND_LOAD} 00:00:00"), table)
    return _ntz(spark.table(table), "effective_from", "effective_to")


def _scratch_db(spark: SparkSession, name: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def crimes_silver_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crimes Silver step: quality split on a checkpointed copy,
    uniqueness gate, date-partitioned Silver table, quarantine appended per
    run. Returns the published Silver table."""
    db = _scratch_db(spark, "strata_silver")
    table = f"{db}.crimes_{uuid.uuid4().hex[:12]}"
    run = silver_step(
        spark,
        crimes_bronze(spark, sf_dir),
        silver_crimes,
        crimes_checks(),
        ["case_number"],
        table,
        "occurred_date",
        scratch_path(spark, "crimes_quarantine"),
        run_id="run-0001",
        min_pass_rate=None,  # the crimes step has no pass-rate gate
    )
    assert run.result.total_rows == run.result.passed_rows + run.result.quarantined_rows
    return _ntz(spark.table(table).drop("_ingested_at"), "occurred_at", "updated_on")


def weather_silver_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather Silver step with its 95 % pass-rate gate (checked before
    anything is published). Returns the published Silver table."""
    db = _scratch_db(spark, "strata_silver")
    table = f"{db}.weather_{uuid.uuid4().hex[:12]}"
    silver_step(
        spark,
        _weather_bronze(spark, sf_dir),
        silver_weather,
        weather_checks(),
        ["city", "observed_at"],
        table,
        "observed_date",
        scratch_path(spark, "weather_quarantine"),
        run_id="run-0001",
    )
    return spark.table(table).drop("_ingested_at").withColumn(
        "observed_at", F.col("observed_at").cast("timestamp_ntz")
    )


def crimes_weather_mart_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver for both domains, then the Gold step: two daily tables and the
    mart built from them, read back from the catalog."""
    db = _scratch_db(spark, "strata_gold")
    tag = uuid.uuid4().hex[:12]
    weather_t, crimes_t = f"{db}.silver_weather_{tag}", f"{db}.silver_crimes_{tag}"
    overwrite_table(_weather_silver(spark, sf_dir), weather_t)
    overwrite_table(_crimes_good(spark, sf_dir), crimes_t)
    gold = GoldTables(f"{db}.weather_daily_{tag}", f"{db}.crimes_daily_{tag}", f"{db}.mart_{tag}")
    gold_step(spark, weather_t, crimes_t, gold, mart_root=scratch_path(spark, "mart"))
    return spark.table(gold.crimes_weather_daily)


# -- station stream ---------------------------------------------------------

def station_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as station events (user = station) through the two-hop stream:
    files -> Bronze table -> table stream -> windowed Gold table."""
    base = scratch_path(spark, "stations")
    db = _scratch_db(spark, "strata_streams")
    tag = uuid.uuid4().hex[:12]
    paths = TwoHopPaths(
        f"{base}/landing", f"{base}/bronze", f"{base}/gold", f"{base}/_checkpoints",
        bronze_table=f"{db}.bronze_events_{tag}", gold_table=f"{db}.station_windows_{tag}",
    )
    ev = load(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("trip_id"),
        F.concat(F.lit("S"), _pad("user_id", 4)).alias("station_id"),
        F.concat(F.lit("station "), F.col("user_id").cast("string")).alias("station_name"),
        F.when(F.col("value") > 100, "member").otherwise("casual").alias("rider_type"),
        F.col("event_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("event_ts"),
    )
    ev.write.mode("overwrite").json(paths.landing)
    station_stream_pass(spark, paths, state_partitions=8)
    return _ntz(spark.table(paths.gold_table), "window_start", "window_end")


DOMAIN_QUERIES = {
    "weather_flatten": weather_flatten,
    "weather_silver": weather_silver,
    "weather_gold_daily": weather_gold_daily,
    "crimes_silver": crimes_silver,
    "crimes_quarantine": crimes_quarantine,
    "crimes_gold_daily": crimes_gold_daily,
    "crimes_weather_mart": crimes_weather_mart,
    "iucr_dimension": iucr_dimension,
    "station_windows": station_windows,
    "crimes_silver_published": crimes_silver_published,
    "weather_silver_published": weather_silver_published,
    "crimes_weather_mart_published": crimes_weather_mart_published,
}
