from datetime import datetime

import pytest

from strata.operators.quality import expect_between, expect_not_null
from strata.plans.medallion import silver_step
from strata.plans.weather import silver_weather

SCHEMA = ("city string, observed_at string, temperature_2m string, relative_humidity_2m string, "
          "precipitation string, wind_speed_10m string, _ingested_at timestamp")


def _bronze(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _checks():
    return [expect_not_null("city", "observed_at"), expect_between("wind_speed_10m", 0, 100)]


def test_silver_step_gates_before_publishing(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS medtest LOCATION '{scratch('db')}'")
    t, q = "medtest.silver_weather", scratch("quarantine")
    ok = [("tromso", f"2025-02-0{d}T06:00", "-8.5", "71", "0.2", "33", datetime(2025, 2, 9)) for d in range(1, 5)]
    run = silver_step(spark, _bronze(spark, ok), silver_weather, _checks(), ["city", "observed_at"],
                      t, "observed_date", q, "run-1")
    assert run.result.pass_rate == 1.0
    assert spark.table(t).count() == 4
    assert sorted(str(r.observed_date) for r in spark.table(t).collect())[0] == "2025-02-01"

    # half the rows fail: the gate raises and the table still holds run 1
    bad = ok[:2] + [("tromso", f"2025-02-0{d}T06:00", "-8.5", "71", "0.2", "412", datetime(2025, 2, 9)) for d in (5, 6)]
    with pytest.raises(ValueError, match="quality gate"):
        silver_step(spark, _bronze(spark, bad), silver_weather, _checks(), ["city", "observed_at"],
                    t, "observed_date", q, "run-2")
    assert spark.table(t).count() == 4

    # without a gate the run publishes its good rows and quarantines the rest (idempotent per run)
    for _ in range(2):
        run = silver_step(spark, _bronze(spark, bad), silver_weather, _checks(), ["city", "observed_at"],
                          t, "observed_date", q, "run-3", min_pass_rate=None)
    assert spark.table(t).count() == 2
    quarantined = spark.read.parquet(q).collect()
    assert len(quarantined) == 2
    assert all(r["_dq_failures"] == ["between(wind_speed_10m,0,100)"] for r in quarantined)
    assert "_dq_failures" not in spark.table(t).columns
    spark.sql("DROP DATABASE medtest CASCADE")


WEATHER = "city string, observed_at string, temperature_2m double, relative_humidity_2m double, precipitation double, wind_speed_10m double"
CRIMES = ("case_number string, date string, updated_on string, primary_type string, arrest string, domestic string, "
          "latitude string, longitude string, iucr string, description string")


@pytest.fixture()
def layout(spark, scratch, request):
    from strata.plans.medallion import GoldTables, MedallionLayout

    db = f"daily_{request.node.name[:30].lower()}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch('db')}'")
    base = scratch("medallion")
    yield MedallionLayout(
        f"{base}/landing", f"{base}/bronze", f"{base}/quarantine",
        f"{db}.silver_weather", f"{db}.silver_crimes", f"{db}.dim_iucr",
        GoldTables(f"{db}.weather_daily", f"{db}.crimes_daily", f"{db}.crimes_weather_daily"),
    )
    spark.sql(f"DROP DATABASE {db} CASCADE")


def _hours(spark, day, temps, city="chicago"):
    return spark.createDataFrame([(city, f"{day}T{h:02d}:00", t, 55.0, 0.25, 7.5) for h, t in enumerate(temps)], WEATHER)


def _cases(spark, rows):
    return spark.createDataFrame([(c, f"{d}T08:30", u, kind, arrest, "false", "41.75", "-87.65", code, text) for c, d, u, kind, arrest, code, text in rows], CRIMES)


def test_run_daily_end_to_end(spark, layout):
    from strata.plans.medallion import run_daily
    from strata.sources.landing import land_batch
    from strata.sources.versions import read_version, versions

    weather = _hours(spark, "2025-03-04", [4.0, 9.0, 17.0]).union(_hours(spark, "2025-03-04", [-400.0], "oslo"))
    crimes = _cases(spark, [
        ("jd71", "2025-03-04", "2025-03-05", "burglary", "true", "0610", "FORCED"), ("JD72", "2025-03-04", "2025-03-05", "burglary", "false", "0610", "FORCED"),
        ("JD73", "2025-03-04", "2025-03-05", "burglary", "false", "0610", "FORCED"), ("JD74", "someday", "2025-03-05", "fraud", "false", "1130", "FORGED"),
    ])
    land_batch(weather, layout.landing_root, "weather", "2025-03-05", "w1")
    land_batch(crimes, layout.landing_root, "crimes", "2025-03-05", "c1")
    results = run_daily(spark, layout, "2025-03-05")
    assert results["weather"].pass_rate == 1.0
    assert (results["crimes"].total_rows, results["crimes"].quarantined_rows) == (4, 1)
    mart = {str(r.occurred_date): r for r in spark.table(layout.gold.crimes_weather_daily).collect()}
    assert mart["2025-03-04"].incidents == 3 and mart["2025-03-04"].temp_avg_c == 10.0
    daily = spark.table(layout.gold.crimes_daily).collect()
    assert [(r.incident_count, r.arrest_count, r.arrest_rate) for r in daily] == [(3, 1, 0.3333)]

    # next day: a description changes; the dimension keeps the old version closed
    land_batch(_cases(spark, [("JD71", "2025-03-04", "2025-03-06", "burglary", "true", "0610", "UNLAWFUL ENTRY")]), layout.landing_root, "crimes", "2025-03-06", "c2")
    run_daily(spark, layout, "2025-03-06")
    dim = sorted((r.description, r.is_current) for r in spark.table(layout.dim_iucr).filter("iucr = '0610'").collect())
    assert dim == [("FORCED", False), ("UNLAWFUL ENTRY", True)]
    # each day is a version; the one before is still there
    assert versions(spark, layout.silver_crimes) == [1, 2]
    assert "UNLAWFUL ENTRY" not in {r.description for r in read_version(spark, layout.silver_crimes, 1).collect()}


def test_daily_runs_with_marks_resume_and_equal_a_full_recompute(spark, layout, monkeypatch):
    from strata.plans import medallion
    from strata.plans.crimes import gold_crimes_daily
    from strata.plans.weather import gold_daily_weather

    hours = _hours(spark, "2025-03-01", [1.0, 2.0])
    for d, t in (("2025-03-02", [3.0, 4.0]), ("2025-03-03", [5.5]), ("2025-03-04", [7.0, 8.0, 8.25])):
        hours = hours.union(_hours(spark, d, t))
    first = [("e1", "2025-03-01", "2025-03-01 09:00:00", "arson", "true", "1020", "A"), ("e2", "2025-03-02", "2025-03-02 09:00:00", "theft", "false", "0820", "B")]
    later = [("e1", "2025-03-01", "2025-03-04 09:00:00", "arson", "false", "1020", "A2"), ("e3", "2025-03-03", "2025-03-05 09:00:00", "theft", "true", "0820", "B")]

    def run(day, cases):
        feeds = {
            "weather": medallion.WindowFeed(hours, "observed_at", "2025-03-01"),
            "crimes": medallion.CursorFeed(_cases(spark, cases), "updated_on", "2025-01-01"),
        }
        return medallion.run_daily(spark, layout, day, feeds=feeds)

    run("2025-03-04", first)
    ledger = layout.ledger(spark)
    assert ledger.last()[1].marks == {"weather": "2025-03-03", "crimes": "2025-03-02 09:00:00"}

    # the next day fails in the dimension: marks stand after what was landed, Silver is done
    calls, real = [], medallion.silver_refresh
    monkeypatch.setattr(medallion, "silver_refresh", lambda *a, **k: calls.append(a[7]) or real(*a, **k))
    broken = monkeypatch.context()
    with broken as m:
        m.setattr(medallion, "scd2_upsert_iucr", lambda *a: (_ for _ in ()).throw(OSError("catalog is down")))
        with pytest.raises(OSError):
            run("2025-03-06", first + later)
    assert ledger.last()[1].marks == {"weather": "2025-03-05", "crimes": "2025-03-05 09:00:00"}
    assert len(calls) == 2 and spark.table(layout.gold.crimes_daily).count() == 2
    run("2025-03-06", first + later)
    assert len(calls) == 2  # the steps that were done are not done again
    assert ledger.run("run-2025-03-06").done() == {}

    for table, daily, silver in ((layout.gold.weather_daily, gold_daily_weather, layout.silver_weather), (layout.gold.crimes_daily, gold_crimes_daily, layout.silver_crimes)):
        want = daily(spark.table(silver))
        assert sorted(map(repr, spark.table(table).select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    assert spark.table(layout.silver_weather).count() == 8 and spark.table(layout.silver_crimes).count() == 3
    arrests = {(str(r.occurred_date), r.primary_type): r.arrest_count for r in spark.table(layout.gold.crimes_daily).collect()}
    assert arrests == {("2025-03-01", "ARSON"): 0, ("2025-03-02", "THEFT"): 0, ("2025-03-03", "THEFT"): 1}

    # a window without rows fails and leaves its mark; a cursor without rows is an empty day
    with pytest.raises(ValueError, match="no rows for weather"):
        run("2025-03-20", first + later)
    assert ledger.last()[1].marks["weather"] == "2025-03-05"


def test_gold_takes_in_the_dates_of_a_run_that_was_given_up(spark, layout, monkeypatch):
    from strata.plans import medallion
    from strata.sources.landing import land_batch

    def land(day, source, df):
        land_batch(df, layout.landing_root, source, day, "b")

    land("2025-04-01", "weather", _hours(spark, "2025-03-30", [1.0]))
    land("2025-04-01", "crimes", _cases(spark, [("g1", "2025-03-30", "2025-03-30", "theft", "true", "0820", "B")]))
    medallion.run_daily(spark, layout, "2025-04-01")
    land("2025-04-02", "weather", _hours(spark, "2025-03-31", [2.0]))
    with monkeypatch.context() as m:
        m.setattr(medallion, "gold_step", lambda *a, **k: (_ for _ in ()).throw(OSError("down")))
        with pytest.raises(OSError):
            medallion.run_daily(spark, layout, "2025-04-02")
    land("2025-04-03", "weather", _hours(spark, "2025-04-01", [3.0]))
    medallion.run_daily(spark, layout, "2025-04-03")  # another run: the one before is never resumed
    got = sorted((str(r.observed_date), r.temp_avg_c) for r in spark.table(layout.gold.weather_daily).collect())
    assert got == [("2025-03-30", 1.0), ("2025-03-31", 2.0), ("2025-04-01", 3.0)]
