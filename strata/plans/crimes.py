"""Crimes domain: Silver cleansing, daily Gold with rates, the IUCR code
dimension (SCD2) and the crimes x weather daily mart."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import (
    event_date,
    lenient_cast,
    lenient_timestamp,
    normalise_key,
    null_outside,
)
from strata.operators.dedupe import dedupe_latest
from strata.operators.gold import flag_rates, rollup_mart
from strata.operators.scd2 import scd2_initial, scd2_merge
from strata.sources.versions import publish_version, table_exists

# Fixed values that must stay as they are for results to match:
# the city's bounding box; coordinates outside it are geocoding errors.
LAT_RANGE = (41.6, 42.1)
LON_RANGE = (-87.95, -87.5)
MART_CITY = "chicago"
IUCR_KEYS = ["iucr"]
IUCR_TRACKED = ["primary_type", "description"]


def silver_crimes(bronze: DataFrame) -> DataFrame:
    """Drop rows without case number or date, normalise the case number and
    crime type, type leniently, null impossible coordinates (each on its
    own, the row stays), keep the latest update per case."""
    cleaned = bronze.filter(F.col("case_number").isNotNull() & F.col("date").isNotNull()).withColumns(
        {
            "case_number": normalise_key("case_number"),
            "occurred_at": lenient_timestamp("date"),
            "updated_on": lenient_timestamp("updated_on"),
            "primary_type": normalise_key("primary_type"),
            "arrest": lenient_cast("arrest", "boolean"),
            "domestic": lenient_cast("domestic", "boolean"),
            "latitude": null_outside(lenient_cast("latitude", "double"), *LAT_RANGE),
            "longitude": null_outside(lenient_cast("longitude", "double"), *LON_RANGE),
        }
    )
    ties = [c for c in ("_ingest_date", "_source_file") if c in cleaned.columns]
    deduped = dedupe_latest(cleaned, ["case_number"], "updated_on", tie_breakers=ties)
    return deduped.withColumn("occurred_date", event_date("occurred_at"))


def gold_crimes_daily(silver: DataFrame) -> DataFrame:
    return flag_rates(
        silver,
        ["occurred_date", "primary_type"],
        {"arrest_count": "arrest", "domestic_count": "domestic"},
        count_alias="incident_count",
        rate_of=("arrest_count", "arrest_rate"),
    )


def crimes_weather_daily(
    crimes_daily: DataFrame, weather_daily: DataFrame, city: str = MART_CITY
) -> DataFrame:
    """Incidents per day with that day's weather in ``city`` (NULL when the
    city has no weather row that day)."""
    return rollup_mart(
        crimes_daily,
        weather_daily,
        fact_date="occurred_date",
        dim_date="observed_date",
        dim_filter=F.col("city") == city,
        sum_cols={"incidents": "incident_count"},
        attr_cols={"temp_avg_c": "temp_avg_c", "precip_total_mm": "precip_total_mm"},
    )


def iucr_updates(good: DataFrame, effective_from=None) -> DataFrame:
    """One update per IUCR code from the good Silver rows: the attributes of
    the most recently updated case (deterministic, unlike an arbitrary pick)."""
    latest = dedupe_latest(
        good.filter(F.col("iucr").isNotNull()), IUCR_KEYS, "updated_on", tie_breakers=["case_number"]
    )
    start = F.current_timestamp() if effective_from is None else F.lit(effective_from).cast("timestamp")
    return latest.select(*IUCR_KEYS, *IUCR_TRACKED, start.alias("effective_from"))


def scd2_upsert_iucr(
    spark: SparkSession, updates: DataFrame, target_table: str, root: str | None = None
) -> str:
    """Apply ``updates`` (iucr, primary_type, description, effective_from) to
    the Type 2 dimension ``target_table`` and publish the new version."""
    if not table_exists(spark, target_table):
        return publish_version(spark, scd2_initial(updates), target_table, root)
    merged = scd2_merge(spark.table(target_table), updates, IUCR_KEYS, IUCR_TRACKED)
    return publish_version(spark, merged, target_table, root)
