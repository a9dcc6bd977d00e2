"""Weather domain: hourly payload -> Bronze -> Silver -> daily Gold."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.columns import event_date, lenient_cast, lenient_timestamp, null_outside
from strata.operators.dedupe import dedupe_latest
from strata.operators.flatten import flatten_columnar
from strata.operators.gold import daily_summary

# Fixed values that must stay as they are for results to match:
# physical sanity bounds (Celsius, percent) and the hourly measures.
TEMP_RANGE = (-60.0, 60.0)
HUMIDITY_RANGE = (0.0, 100.0)
HOURLY_MEASURES = ("temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m")


def flatten_hourly(payload: DataFrame, city: str | None = None) -> DataFrame:
    """Columnar ``hourly`` payloads (``{time: [...], var: [...], ...}``) ->
    one row per hour with ``city``, ``observed_at`` and every variable.

    ``payload`` is the raw read of the API documents (one per row). A
    document without ``hourly`` yields no rows; a short variable array yields
    NULL for the hours it misses. ``city`` is a constant, or taken from the
    payload's ``city`` column when None.
    """
    hourly = payload.schema["hourly"].dataType if "hourly" in payload.columns else None
    if not isinstance(hourly, StructType) or "time" not in hourly.names:
        # nothing typed to explode: no document has hours
        return payload.sparkSession.createDataFrame([], "city string, observed_at string")
    keep = ["city"] if city is None and "city" in payload.columns else []
    flat = flatten_columnar(payload, "hourly", index_field="time", keep=keep, index_alias="observed_at")
    if city is not None:
        flat = flat.select(F.lit(city).alias("city"), *flat.columns)
    return flat


def _tie_breakers(df: DataFrame) -> list[str]:
    return [c for c in ("_ingest_date", "_source_file") if c in df.columns]


WEATHER_BOUNDS = {"temperature_2m": TEMP_RANGE, "relative_humidity_2m": HUMIDITY_RANGE}


def silver_weather(bronze: DataFrame, repair: bool = True) -> DataFrame:
    """Type leniently, drop rows without (city, hour), null out-of-range
    temperature / humidity, keep the latest ingestion per (city, hour). Hours
    are few and delivered many times, so tasks combine theirs first.

    With ``repair=False`` out-of-range values are kept, so a quality suite
    run afterwards can quarantine them instead of never seeing them (with
    repair on, the between-checks can no longer fail); ``out_of_range_counts``
    reports what the repair would null."""
    typed = bronze.withColumns(
        {
            "observed_at": lenient_timestamp("observed_at"),
            **{m: lenient_cast(m, "double") for m in HOURLY_MEASURES if m in bronze.columns},
        }
    ).filter(F.col("observed_at").isNotNull() & F.col("city").isNotNull())
    bounded = typed.withColumns(
        {c: null_outside(c, *bounds) for c, bounds in WEATHER_BOUNDS.items()}
    ) if repair else typed
    deduped = dedupe_latest(
        bounded, ["city", "observed_at"], "_ingested_at", tie_breakers=_tie_breakers(bounded), repeated=True
    )
    return deduped.withColumn("observed_date", event_date("observed_at"))


def gold_daily_weather(silver: DataFrame, exact_scale: int | None = 4) -> DataFrame:
    """Per city and day: rounded min / max / mean temperature, total
    precipitation, mean humidity, max wind, and the hour count.

    Measures are aggregated as decimals of ``exact_scale`` digits (sensor
    readings carry one or two), so the rounded daily numbers are the exact
    ones and do not move with the cluster's partitioning; ``None`` keeps
    plain double arithmetic.
    """
    return daily_summary(
        silver,
        ["city", "observed_date"],
        {
            "temp_min_c": ("min", "temperature_2m"),
            "temp_max_c": ("max", "temperature_2m"),
            "temp_avg_c": ("avg", "temperature_2m"),
            "precip_total_mm": ("sum", "precipitation"),
            "humidity_avg_pct": ("avg", "relative_humidity_2m"),
            "wind_max_kmh": ("max", "wind_speed_10m"),
        },
        count_alias="hours_observed",
        exact_scale=exact_scale,
    )
