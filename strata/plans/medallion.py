"""End-to-end steps: Bronze ingest, Silver with quality gates, Gold, and the
station event stream. Each step is one call; orchestration stays outside.

The Silver step (``strata.plans.silver``) gates before it publishes: a failed
gate leaves the table as it was.

A daily run keeps a ledger. Each of its steps is committed when done, marks and
all, so a run that failed resumes at the step that failed. The slices that
Bronze took in since Silver was last brought up to date are noted there, and
Silver and Gold are refreshed for what those slices touch.
"""
from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import lenient_timestamp, normalise_key
from strata.operators.quality import Check, SuiteResult, expect_between, expect_not_null
from strata.plans.crimes import (
    crimes_weather_daily,
    gold_crimes_daily,
    iucr_updates,
    scd2_upsert_iucr,
    silver_crimes,
)
from strata.plans.silver import MIN_PASS_RATE, PASSED_COL, SilverRun, silver_refresh, silver_step  # noqa: F401
from strata.plans.weather import gold_daily_weather, silver_weather
from strata.sources.incremental import advance_cursor, date_window, read_date_window, read_since
from strata.sources.landing import ingest_bronze, land_batch, landed_batch
from strata.sources.ledger import LedgerConflict, Run, RunLedger, State
from strata.sources.tables import read_slices
from strata.sources.versions import current_version, publish_version
from strata.streaming import sources as stream_sources
from strata.streaming.lines import lines_pass
from strata.streaming.sinks import RunStats, TwoHopPaths, stream_pass

# Fixed values that must stay as they are for results to match:
# the station stream's schema hints, window and watermark.
EVENT_SCHEMA_HINTS = (
    "trip_id STRING, station_id STRING, station_name STRING, "
    "rider_type STRING, event_type STRING, event_ts TIMESTAMP"
)
STATION_WINDOW = "10 minutes"
STATION_WATERMARK = "15 minutes"


@dataclass
class GoldTables:
    weather_daily: str
    crimes_daily: str
    crimes_weather_daily: str


def gold_rows(spark: SparkSession, daily, silver: DataFrame, table: str, date: Column, dates: Sequence | None) -> DataFrame:
    """A daily Gold table in full, or the one there is with the given dates
    computed anew: a date's rows depend on the Silver rows of that date alone.
    ``date`` is an expression over columns that Silver and Gold both have."""
    if dates is None or current_version(spark, table) is None:
        return daily(silver)
    on = date.isin([F.lit(d).cast("date") for d in dates if d is not None])
    if None in dates:
        on = on | date.isNull()
    fresh = daily(silver.where(on))
    old = spark.table(table)
    if old.schema.simpleString() != fresh.schema.simpleString():
        return daily(silver)
    return old.where(~F.coalesce(on, F.lit(False))).unionByName(fresh)


def gold_step(
    spark: SparkSession,
    silver_weather_table: str,
    silver_crimes_table: str,
    gold: GoldTables,
    mart_root: str | None = None,
    weather_dates: Sequence | None = None,
    crimes_dates: Sequence | None = None,
) -> None:
    """Gold: both daily tables, then the cross-domain mart computed from the
    tables just written. Each is a new version: a failed write leaves the old
    one in place. With the dates that a Silver refresh wrote, only those dates
    are read from Silver and aggregated; the others are kept."""
    weather = gold_rows(spark, gold_daily_weather, spark.table(silver_weather_table), gold.weather_daily, F.col("observed_date"), weather_dates)
    publish_version(spark, weather, gold.weather_daily, mart_root)
    crimes = gold_rows(spark, gold_crimes_daily, spark.table(silver_crimes_table), gold.crimes_daily, F.col("occurred_date"), crimes_dates)
    publish_version(spark, crimes, gold.crimes_daily, mart_root)
    mart = crimes_weather_daily(spark.table(gold.crimes_daily), spark.table(gold.weather_daily))
    publish_version(spark, mart, gold.crimes_weather_daily, mart_root)


def read_events_stream(spark: SparkSession, source_path: str, schema_location: str) -> DataFrame:
    """The station event stream with its schema hints."""
    return stream_sources.read_events_stream(spark, source_path, schema_location, EVENT_SCHEMA_HINTS)


def station_stream_pass(
    spark: SparkSession, paths: TwoHopPaths, state_partitions: int, max_files_per_trigger: int | None = 1000,
    evolve_schema: bool = True,
) -> tuple[RunStats, RunStats]:
    """Landing drop zone -> Bronze events -> 10-minute station windows. New
    fields of the events are taken up unless ``evolve_schema`` is off."""
    return stream_pass(
        spark,
        paths,
        ts_col="event_ts",
        keys=["station_id", "event_type"],
        required=["trip_id", "event_ts"],
        hints_ddl=EVENT_SCHEMA_HINTS,
        size=STATION_WINDOW,
        delay=STATION_WATERMARK,
        max_files_per_trigger=max_files_per_trigger,
        state_partitions=state_partitions,
        evolve_schema=evolve_schema,
    )


def station_lines_pass(
    spark: SparkSession, paths: TwoHopPaths, state_partitions: int, max_files_per_trigger: int | None = 1000,
    late_path: str | None = None,
) -> tuple[RunStats, RunStats]:
    """The same pass with lines landed as text first: no field is lost, nothing
    is inferred, a batch that runs twice counts once, and ``late_path`` keeps
    what the watermark drops. Its folders are not those of
    :func:`station_stream_pass`."""
    return lines_pass(
        spark,
        paths,
        ts_col="event_ts",
        keys=["station_id", "event_type"],
        required=["trip_id", "event_ts"],
        hints_ddl=EVENT_SCHEMA_HINTS,
        size=STATION_WINDOW,
        delay=STATION_WATERMARK,
        max_files_per_trigger=max_files_per_trigger,
        state_partitions=state_partitions,
        late_path=late_path,
    )


@dataclass
class MedallionLayout:
    """Where one deployment keeps its layers. The run ledger is beside Bronze
    unless ``ledger_path`` names another folder."""
    landing_root: str
    bronze_root: str
    quarantine_root: str
    silver_weather: str
    silver_crimes: str
    dim_iucr: str
    gold: GoldTables
    ledger_path: str | None = None

    def ledger(self, spark: SparkSession) -> RunLedger:
        return RunLedger(spark, self.ledger_path or f"{self.bronze_root.rstrip('/')}/_ledger")


@dataclass
class WindowFeed:
    """A source read by date window, from its mark to ``lag_days`` before the
    run's date, both included. A window without rows is an error."""
    rows: DataFrame
    date_col: str
    start: str
    lag_days: int = 2

    def land(self, run: Run, layout: MedallionLayout, source: str, ingest_date: str) -> dict:
        window = date_window(run.ledger.last()[1].marks.get(source, self.start), ingest_date, self.lag_days)
        if window is None:
            return {"landed": None, "mark": None}
        first, last = window
        rows = read_date_window(self.rows, self.date_col, first, last)
        if rows.isEmpty():
            raise ValueError(f"no rows for {source} in [{first}, {last}]")
        batch = land_batch(rows, layout.landing_root, source, ingest_date, f"{first}_{last}")
        return {"landed": batch, "mark": (last + timedelta(days=1)).isoformat()}


@dataclass
class CursorFeed:
    """A source read by cursor: rows after its mark, which then is the greatest
    value landed. Nothing new leaves the mark."""
    rows: DataFrame
    cursor_col: str
    start: str

    def land(self, run: Run, layout: MedallionLayout, source: str, ingest_date: str) -> dict:
        mark = run.ledger.last()[1].marks.get(source, self.start)
        rows = read_since(self.rows, self.cursor_col, mark)
        if rows.isEmpty():
            return {"landed": None, "mark": None}
        batch = land_batch(rows, layout.landing_root, source, ingest_date, "after-" + re.sub("[^0-9A-Za-z]+", "-", mark))
        # the mark is what was landed, not what a second read of the source finds
        return {"landed": batch, "mark": str(advance_cursor(landed_batch(rows.sparkSession, batch, rows.schema), self.cursor_col, mark))}


def weather_checks() -> list[Check]:
    # fixed values: the Silver weather gate's bounds, written as whole numbers
    # so the check names read between(temperature_2m,-60,60) and
    # between(relative_humidity_2m,0,100)
    return [
        expect_not_null("city", "observed_at"),
        expect_between("temperature_2m", -60, 60),
        expect_between("relative_humidity_2m", 0, 100),
    ]


def crimes_checks() -> list[Check]:
    return [expect_not_null("case_number", "occurred_at")]


def crimes_keys() -> dict:
    """The key of a Silver crime, from Bronze columns."""
    return {"case_number": normalise_key("case_number")}


def weather_keys() -> dict:
    return {"city": F.col("city"), "observed_at": lenient_timestamp("observed_at")}


def _noted(result: SilverRun) -> dict:
    """A Silver step as the ledger keeps it; dates as text."""
    dates = None if result.dates is None else [None if d is None else str(d) for d in result.dates]
    r = result.result
    return {"total": r.total_rows, "passed": r.passed_rows, "quarantined": r.quarantined_rows, "failures": r.failures_by_check, "dates": dates}


def run_daily(
    spark: SparkSession, layout: MedallionLayout, ingest_date: str, run_id: str | None = None,
    multi_line: Collection[str] = (), feeds: Mapping[str, WindowFeed | CursorFeed] | None = None,
) -> dict[str, SuiteResult]:
    """One scheduled batch: sources landed from their marks (``feeds``, by
    source; without one the landing zone is filled by others), both sources'
    landing slices into Bronze, the two Silver steps (weather gated at 95 %,
    crimes not gated), the IUCR code dimension, then Gold. Returns the quality
    results per source. ``multi_line`` names the sources whose files are JSON
    spread over lines.

    Steps are committed to the run ledger one by one. A call after a failure
    goes on with the step that failed; a call after a finished run does the
    day again."""
    ledger = layout.ledger(spark)
    run = ledger.run(run_id or f"run-{ingest_date}")

    def slice_changed(source: str):
        def note(state: State, _) -> None:
            waiting = state.notes.setdefault(f"slices:{source}", [])
            waiting += [d for d in [ingest_date] if d not in waiting]

        return note

    def silver_done(source: str, taken: Sequence[str]):
        def note(state: State, result: dict) -> None:
            state.notes[f"slices:{source}"] = [d for d in state.notes.get(f"slices:{source}", []) if d not in taken]
            waiting = state.notes.get(f"dates:{source}", [])
            both = None if waiting is None or result["dates"] is None else waiting + [d for d in result["dates"] if d not in waiting]
            state.notes[f"dates:{source}"] = both  # None: all dates

        return note

    def mark_moved(source: str, before: str | None):
        def note(state: State, landed: dict) -> None:
            if landed["mark"] is not None:
                if state.marks.get(source) != before:
                    raise LedgerConflict(f"the mark of {source} moved during the landing")
                state.marks[source] = landed["mark"]

        return note

    for source in ("weather", "crimes"):
        if feeds and source in feeds:
            before = ledger.last()[1].marks.get(source)
            run.step(f"land:{source}", lambda s=source: feeds[s].land(run, layout, s, ingest_date), mark_moved(source, before))
        run.step(
            f"bronze:{source}",
            lambda s=source: ingest_bronze(spark, layout.landing_root, s, f"{layout.bronze_root}/{s}", ingest_date, multi_line=s in multi_line),
            slice_changed(source),
        )

    def silver(source: str, keys: dict, transform, checks: list[Check], table: str, partition_col: str, min_pass_rate: float | None) -> dict:
        waiting = ledger.last()[1].notes.get(f"slices:{source}", [])
        return run.step(
            f"silver:{source}",
            lambda: _noted(silver_refresh(
                spark, read_slices(spark, f"{layout.bronze_root}/{source}"), waiting, keys, transform, checks, list(keys), table,
                partition_col, f"{layout.quarantine_root}/{source}", run.run_id, min_pass_rate,
            )),
            silver_done(source, waiting),
        )

    weather = silver("weather", weather_keys(), silver_weather, weather_checks(), layout.silver_weather, "observed_date", MIN_PASS_RATE)
    crimes = silver("crimes", crimes_keys(), silver_crimes, crimes_checks(), layout.silver_crimes, "occurred_date", None)
    run.step("dimension", lambda: scd2_upsert_iucr(spark, iucr_updates(spark.table(layout.silver_crimes)), layout.dim_iucr))

    def gold() -> None:
        # dates that Silver wrote since Gold last took them in, by this run or one that was given up
        waiting = ledger.last()[1].notes
        gold_step(
            spark, layout.silver_weather, layout.silver_crimes, layout.gold,
            weather_dates=waiting.get("dates:weather", []), crimes_dates=waiting.get("dates:crimes", []),
        )

    def gold_done(state: State, _) -> None:
        state.notes["dates:weather"] = state.notes["dates:crimes"] = []

    run.step("gold", gold, gold_done)
    run.finish()
    return {s: SuiteResult(r["total"], r["passed"], r["quarantined"], r["failures"]) for s, r in (("weather", weather), ("crimes", crimes))}
