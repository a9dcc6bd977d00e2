"""Plan-shape checks: the properties the scale notes in the README rely on."""
import contextlib
import io
import re

from pyspark.sql import functions as F

from strata.operators.dedupe import combine_latest, dedupe_latest
from strata.operators.gold import daily_summary, rollup_mart
from strata.operators.quality import expect_between, expect_not_null, tag_failures
from strata.plans.weather import silver_weather
from strata.sources.incremental import read_since


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_dedupe_limits_before_the_shuffle(spark):
    # one key holds a third of the rows
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    out = dedupe_latest(df, ["k"], "v")
    plan = _plan(out)
    limits = [int(n) for n in re.findall(r"^\((\d+)\) WindowGroupLimit", plan, re.M)]
    exchanges = [int(n) for n in re.findall(r"^\((\d+)\) Exchange", plan, re.M)]
    # nodes are numbered from the scan up: partial limit, exchange, final limit
    assert len(limits) == 2 and len(exchanges) == 1
    assert limits[0] < exchanges[0] < limits[1]
    assert dict((r.k, r.v) for r in out.collect())[0] == 2997


def test_aggregate_is_partial_then_final(spark):
    df = spark.range(0, 100).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("x"))
    plan = _plan(daily_summary(df, ["g"], {"s": ("sum", "x")}, exact_scale=2))
    assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan


def test_cursor_filter_reaches_the_scan(spark, scratch):
    path = scratch("cursor")
    spark.range(0, 10).withColumn("u", F.col("id").cast("timestamp")).write.parquet(path)
    plan = _plan(read_since(spark.read.parquet(path), "u", "1970-01-01 00:00:05").select("id"))
    assert "PushedFilters: [IsNotNull(u), GreaterThan(u," in plan
    assert "ReadSchema: struct<id:bigint,u:timestamp>" in plan


def test_mart_has_no_broadcast_hint(spark):
    facts = spark.range(0, 10).select(F.col("id").alias("d"), F.lit(1).alias("n"))
    dims = spark.range(0, 10).select(F.col("id").alias("d"), F.lit("x").alias("c"), F.lit(1.0).alias("t"))
    out = rollup_mart(facts, dims, "d", "d", F.col("c") == "x", {"n": "n"}, {"t": "t"})
    assert "broadcast" not in str(out._jdf.queryExecution().logical()).lower()


def test_quality_tagging_stays_in_codegen(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(0, 10).select(F.col("id").cast("double").alias("x"))
        tagged = tag_failures(df, [expect_not_null("x"), expect_between("x", 0, 5)])
        plan = _plan(tagged.filter(F.size("_dq_failures") > 0))
        for line in plan.splitlines():
            if line.startswith("(") and (" Project" in line or " Filter" in line):
                assert "codegen id" in line, line
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_date_window_filter_reaches_the_scan(spark, scratch):
    from datetime import date

    from strata.sources.incremental import read_date_window

    path = scratch("window")
    spark.range(0, 10).withColumn("u", F.col("id").cast("timestamp").cast("timestamp_ntz")).write.parquet(path)
    plan = _plan(read_date_window(spark.read.parquet(path), "u", date(1970, 1, 1), date(1970, 1, 2)))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line][0]
    assert "GreaterThanOrEqual(u," in pushed and "LessThan(u," in pushed


def test_repeated_hours_are_combined_before_the_sort(spark):
    # 20,000 deliveries of 24 hours by 2 tasks: 48 rows are left to sort
    raw = spark.range(0, 20_000, 1, 2).select(
        F.lit("chicago").alias("city"), F.expr("concat('2026-01-01T', lpad(id % 24, 2, '0'), ':00')").alias("observed_at"),
        *[F.lit("1.5").alias(m) for m in ("temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m")],
        F.timestamp_seconds(F.col("id") % 7).alias("_ingested_at"), F.format_string("f-%05d", "id").alias("_source_file"),
    )
    assert combine_latest(raw, ["city", "observed_at"], ["_ingested_at", "_source_file"]).count() == 48
    silver = silver_weather(raw)
    plan = _plan(silver)
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, re.M)  # numbered from the scan up
    assert nodes.index("MapInArrow") < nodes.index("Sort") < nodes.index("Exchange")
    rows = silver.collect()
    assert len(rows) == 24 and all(r["_ingested_at"].second == 6 for r in rows)
    assert {r["observed_at"].hour: r["_source_file"] for r in rows}[0] == "f-" + str(max(i for i in range(0, 20_000, 24) if i % 7 == 6)).zfill(5)
