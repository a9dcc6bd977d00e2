"""Bundled queries over what one run leaves for the next: refreshed Silver and
Gold, published versions, the run ledger, namespaces. With their oracle SQL."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.gold import daily_summary
from strata.plans.bundled import load
from strata.plans.bundled_domain import _ntz, _scratch_db, crimes_bronze
from strata.plans.bundled_sql import _CRIMES, _CSILVER_COLS, ORACLE_SQL
from strata.plans.crimes import gold_crimes_daily, silver_crimes
from strata.plans.medallion import gold_rows, crimes_checks, crimes_keys
from strata.plans.silver import silver_refresh
from strata.session import path_exists, scratch_path
from strata.sources.incremental import load_date_window
from strata.sources.ledger import RunLedger
from strata.sources.tables import MEDALLION_NAMESPACES, ensure_folders, ensure_namespaces, read_slices, replace_slice, write_slices
from strata.sources.versions import current_version, overwrite_table, publish_version

# Fixed parameters (the oracle SQL uses the same values).
SECOND_SLICE = "1998-01-01"
WITHDRAWN_STATUS = "P"
LEDGER_START = "1997-06-01"
LEDGER_DAYS = ("1997-09-03", "1997-12-03")


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Crimes Silver and daily Gold kept up to date over three loads: the cases
    before 1998, the rest as a second slice, and that slice delivered again
    without some of its cases. Silver is partitioned by month (the cases of a
    day are few here), and Gold takes in the months that Silver wrote."""
    path, quarantine = scratch_path(spark, "refreshed_bronze"), scratch_path(spark, "refreshed_quarantine")
    tag = uuid.uuid4().hex[:12]
    db = _scratch_db(spark, "strata_refreshed")
    silver, gold = f"{db}.silver_{tag}", f"{db}.gold_{tag}"
    feed = crimes_bronze(spark, sf_dir).drop("_ingest_date")
    late = F.to_date(F.substring("updated_on", 1, 10)) >= F.lit(SECOND_SLICE).cast("date")
    month = F.trunc("occurred_date", "month")
    transform = lambda bronze: silver_crimes(bronze).withColumn("occurred_month", month)
    withdrawn = F.col("description").endswith(f"/ {WITHDRAWN_STATUS}")
    loads = [("d1", feed.where(~late)), ("d2", feed.where(late)), ("d2", feed.where(late & ~withdrawn))]
    for n, (day, rows) in enumerate(loads):
        replace_slice(rows, path, "_ingest_date", day)
        run = silver_refresh(
            spark, read_slices(spark, path), [day], crimes_keys(), transform, crimes_checks(), ["case_number"],
            silver, "occurred_month", quarantine, f"load-{n}", min_pass_rate=None,
        )
        publish_version(spark, gold_rows(spark, gold_crimes_daily, spark.table(silver), gold, month, run.dates), gold)
    return silver, gold


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crimes Silver after three refreshes equals Silver computed whole."""
    silver, _ = _refreshed(spark, sf_dir)
    return _ntz(spark.table(silver).drop("_ingested_at", "_ingest_date", "occurred_month"), "occurred_at", "updated_on")


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily crimes Gold of which each refresh computed the touched dates only."""
    return spark.table(_refreshed(spark, sf_dir)[1])


def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One name published with a column added, retyped and dropped, and with
    partitions, then overwritten as a managed table of the same shape."""
    db, tag = _scratch_db(spark, "strata_published"), uuid.uuid4().hex[:12]
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    t = f"{db}.orders_{tag}"
    publish_version(spark, o.select("o_orderkey", "o_custkey"), t)
    publish_version(spark, o.select("o_orderkey", "o_custkey", "o_orderstatus"), t)
    publish_version(spark, spark.table(t).select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus"), t, base=2)
    by_status = spark.table(t).join(o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_totalprice", "o_orderdate"), "o_orderkey")
    publish_version(spark, by_status, t, partition_by=["o_orderstatus"])
    shown = spark.table(t).withColumn("version", F.lit(current_version(spark, t)))
    m = f"{db}.managed_{tag}"
    shown.limit(0).write.saveAsTable(m)
    overwrite_table(shown, m)
    return spark.table(m)


def run_ledger_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two date windows of orders landed under a ledger with a failure between:
    the landing of the second is lost, and the mark stands after the first."""
    ledger, path = RunLedger(spark, scratch_path(spark, "ledger")), scratch_path(spark, "ledger_windows")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")

    def land(rows: DataFrame) -> None:
        rows.write.mode("append").parquet(path)

    def lost(rows: DataFrame) -> None:
        rows.agg(F.count(F.lit(1))).collect()  # the work is done, but its result never arrives
        raise OSError("the store cannot be reached")

    for day, landing in zip(LEDGER_DAYS, (land, lost), strict=True):
        try:
            ledger.run(f"day-{day}").step("land", lambda d=day, f=landing: str(load_date_window(o, "o_orderdate", ledger.marks(), "orders", LEDGER_START, d, f)))
        except OSError:
            pass
    number, state = ledger.last()
    done = sorted(f"{run}:{step}" for run, steps in state.runs.items() for step in steps)
    return spark.read.parquet(path).withColumns({"mark": F.lit(state.marks["orders"]), "steps": F.lit(",".join(done))})


def namespace_setup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Namespaces and folders set up twice under a root of their own, then each
    nation's customers counted into a table of every namespace."""
    root, tag = scratch_path(spark, "namespaces"), uuid.uuid4().hex[:8]
    names = [f"{n}_{tag}" for n in MEDALLION_NAMESPACES]
    for _ in range(2):
        ensure_namespaces(spark, names, root=root)
        folders = ensure_folders(spark, root)
    counts = load(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    out = None
    for layer, name in zip(MEDALLION_NAMESPACES, names, strict=True):
        publish_version(spark, counts, f"{name}.customers")
        below = spark.catalog.getDatabase(name).locationUri.endswith(f"/{name}")
        rows = spark.table(f"{name}.customers").select(F.lit(layer).alias("layer"), "c_nationkey", "customers", F.lit(below).alias("below_root"))
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("folders", F.lit(sum(path_exists(spark, f) for f in folders)))


def gold_daily_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event summaries with readings of 1e17 and NaN among them: their
    days have the plain double result, the others the exact one."""
    e = load(spark, sf_dir, "events")
    reading = F.when(F.col("value") > 420, F.lit(1e17)).when(F.col("value") < 0.2, F.lit(float("nan"))).otherwise(F.col("value"))
    rows = e.select("event_type", F.col("ts").cast("date").alias("event_date"), reading.alias("reading"))
    out = daily_summary(
        rows, ["event_type", "event_date"], {"low": ("min", "reading"), "high": ("max", "reading"), "total": ("sum", "reading")},
        count_alias="n_events", exact_scale=2, inexact_alias="n_inexact",
    )
    # sums with 1e17 in them depend on the order of addition beyond whole numbers
    return out.withColumn("total", F.when((F.col("n_inexact") > 0) & ~F.isnan("total"), F.round(F.col("total") / 1e6)).otherwise(F.col("total")))


def emptied_time_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events sliced by hour of day (10:00, 11:00, ...) in a folder; two hours
    are emptied, one is replaced by its purchases."""
    path = scratch_path(spark, "hours")
    e = load(spark, sf_dir, "events").select("event_id", "event_type", F.date_format("ts", "HH:00").alias("at"))
    write_slices(e, path, "at")
    for hour in ("10:00", "23:00"):
        replace_slice(e.where(F.lit(False)), path, "at", hour)
    replace_slice(e.where("at = '07:00' and event_type = 'purchase'"), path, "at", "07:00")
    return read_slices(spark, path)


LAKE_QUERIES = {
    "silver_incremental": silver_incremental,
    "gold_incremental": gold_incremental,
    "published_versions": published_versions,
    "run_ledger_windows": run_ledger_windows,
    "namespace_setup": namespace_setup,
    "gold_daily_extremes": gold_daily_extremes,
    "emptied_time_slices": emptied_time_slices,
}

_AFTER_LOADS = _CRIMES.replace(
    "  FROM orders\n",
    f"  FROM orders\n  WHERE NOT (CAST(o_orderdate AS DATE) >= DATE '{SECOND_SLICE}' AND o_orderstatus = '{WITHDRAWN_STATUS}')\n",
)
assert _AFTER_LOADS != _CRIMES

LAKE_SQL = {
    "silver_incremental": f"""
WITH {_AFTER_LOADS}
SELECT {_CSILVER_COLS.replace("_ingest_date, ", "")} FROM cgood""",
    "gold_incremental": ORACLE_SQL["crimes_gold_daily"].replace(_CRIMES, _AFTER_LOADS),
    "published_versions": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus, CAST(4 AS INTEGER) AS version
FROM orders""",
    "run_ledger_windows": f"""
SELECT o_orderkey, o_custkey, o_orderdate, '1997-09-02' AS mark, 'day-{LEDGER_DAYS[0]}:land' AS steps
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{LEDGER_START}' AND DATE '1997-09-01'""",
    "namespace_setup": f"""
SELECT layer, c_nationkey, customers, TRUE AS below_root, CAST(3 AS INTEGER) AS folders
FROM (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey),
     (SELECT unnest([{", ".join(f"'{n}'" for n in MEDALLION_NAMESPACES)}]) AS layer)""",
    "gold_daily_extremes": """
WITH r AS (
  SELECT event_type, CAST(ts AS DATE) AS event_date,
    CASE WHEN value > 420 THEN 1e17 WHEN value < 0.2 THEN CAST('NaN' AS DOUBLE) ELSE value END AS reading
  FROM events
)
SELECT event_type, event_date, min(reading) AS low, max(reading) AS high, count(*) AS n_events,
  count(*) FILTER (WHERE isnan(reading) OR reading = 1e17) AS n_inexact,
  CASE WHEN bool_or(isnan(reading)) THEN CAST('NaN' AS DOUBLE)
       WHEN max(reading) = 1e17 THEN round(sum(reading) / 1e6)
       ELSE CAST(sum(CAST(CASE WHEN isnan(reading) OR reading = 1e17 THEN 0 ELSE reading END AS DECIMAL(18, 2))) AS DOUBLE) END AS total
FROM r GROUP BY event_type, event_date""",
    "emptied_time_slices": """
SELECT event_id, event_type, strftime(ts, '%H:00') AS at FROM events
WHERE strftime(ts, '%H') NOT IN ('10', '23') AND (strftime(ts, '%H') <> '07' OR event_type = 'purchase')""",
}
