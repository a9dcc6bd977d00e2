"""Every operator, run over the bundled tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole of its input tables; ``strata.plans.bundled_sql`` holds the equivalent
SQL the oracle runs on the same files. Dirty inputs (NULLs, malformed strings,
out-of-range values) do not exist in the bundled files, so they are derived
from row content with the same CASE expressions on both sides.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import (
    event_date,
    lenient_cast,
    lenient_timestamp,
    normalise_key,
    null_outside,
)
from strata.operators.dedupe import dedupe_latest
from strata.operators.flatten import flatten_columnar
from strata.operators.gold import daily_summary, flag_rates, rollup_mart
from strata.operators.lineage import stamp_slice
from strata.operators.quality import (
    FAILURES_COL,
    assert_unique,
    duplicate_groups,
    expect_between,
    expect_not_null,
    expect_values_in,
    gate_pass_rate,
    run_suite,
    suite_metrics,
    tag_failures,
)
from strata.operators.scd2 import scd2_initial, scd2_merge
from strata.operators.windows import window_counts
from strata.session import scratch_path
from strata.sources.tables import append_run

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the bundled queries (the oracle SQL uses the same values).
SLICE_DATE = "2024-01-01"
SLICE_PATH = "landing/orders/ingest_date=2024-01-01"
ACCTBAL_RANGE = (0.0, 9000.0)
NATION_RANGE = (0, 20)
EVENT_VALUE_RANGE = (0.0, 400.0)
EVENT_ACCEPTED_RANGE = (0.0, 350.0)
REDELIVERED_TYPE = "click"
UNKEYED_PRIORITY = "5-LOW"
DQ_ACCTBAL = (0, 9500)
DQ_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]
SCD2_CUTOFFS = ("1996-01-01", "1999-01-01", "2002-01-01")
MART_FLAG = "R"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


# -- Bronze -----------------------------------------------------------------

def bronze_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = stamp_slice(load(spark, sf_dir, "orders"), "orders", SLICE_DATE, SLICE_PATH)
    return stamped.drop("_ingested_at")  # one clock reading per query: not comparable


# -- Silver: typing, normalisation, repair -----------------------------------

def _raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a string-typed bronze feed with derived dirt."""
    o = load(spark, sf_dir, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    key = F.col("o_orderkey").cast("string")
    low_pending = (status == "P") & (priority == "5-LOW")
    return o.select(
        # padded for medium priority, missing for open urgent orders
        F.when(priority == "3-MEDIUM", F.concat(F.lit(" "), key, F.lit(" ")))
        .when(~((status == "O") & (priority == "1-URGENT")), key)
        .alias("raw_key"),
        F.when(low_pending, F.lit("not-a-date"))
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("raw_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".25"))).alias("raw_amount"),
        F.when(F.col("o_orderstatus") == "F", F.lit("true"))
        .when(F.col("o_orderstatus") == "O", F.lit("false"))
        .otherwise(F.lit("maybe")).alias("raw_flag"),
    )


def lenient_typing(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_orders(spark, sf_dir)
    typed = raw.filter(F.col("raw_key").isNotNull() & F.col("raw_date").isNotNull()).select(
        normalise_key("raw_key").alias("order_key"),
        lenient_timestamp("raw_date").alias("_ts"),
        lenient_cast("raw_amount", "double").alias("amount"),
        lenient_cast("raw_flag", "boolean").alias("fulfilled"),
    )
    return typed.select(
        "order_key",
        F.col("_ts").cast("timestamp_ntz").alias("ordered_at"),
        event_date("_ts").alias("order_date"),
        "amount",
        "fulfilled",
    )


def normalise_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    raw_segment = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))
    raw_name = F.concat(F.lower("c_name"), F.lit("   "))
    return c.select(
        "c_custkey",
        normalise_key(raw_segment).alias("segment"),
        normalise_key(raw_name).alias("name"),
    )


def null_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        null_outside("c_acctbal", *ACCTBAL_RANGE).alias("acctbal"),
        null_outside("c_nationkey", *NATION_RANGE).alias("nationkey"),
    )


def dedupe_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_latest(load(spark, sf_dir, "events"), ["user_id"], "ts")


def dedupe_latest_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_latest(
        load(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        "l_shipdate",
        tie_breakers=["l_partkey", "l_suppkey"],
    )


def flatten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Struct of parallel arrays -> one row per dimension; ``head`` is a
    ragged array (``label * 10`` long) and reads NULL past its end."""
    e = load(spark, sf_dir, "embeddings")
    payload = e.select(
        "vec_id",
        "label",
        F.struct(
            F.sequence(F.lit(0), F.size("embedding") - 1).alias("dim"),
            F.col("embedding").alias("value"),
            F.slice("embedding", 1, F.col("label") * 10).alias("head"),
        ).alias("payload"),
    )
    return flatten_columnar(payload, "payload", index_field="dim", keep=["vec_id", "label"])


# -- Gold -------------------------------------------------------------------

def _events_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.withColumns(
        {
            "event_date": event_date("ts"),
            "value": null_outside("value", *EVENT_VALUE_RANGE),
        }
    )


def gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_summary(
        _events_silver(spark, sf_dir),
        ["event_type", "event_date"],
        {
            "value_min": ("min", "value"),
            "value_max": ("max", "value"),
            "value_avg": ("avg", "value"),
            "value_total": ("sum", "value"),
        },
        count_alias="n_events",
        exact_scale=2,
    )


def _orders_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    fulfilled = (
        F.when(F.col("o_orderstatus") == "F", F.lit(True))
        .when(F.col("o_orderstatus") == "O", F.lit(False))
    )
    return o.select(
        event_date("o_orderdate").alias("order_date"),
        "o_orderpriority",
        fulfilled.alias("fulfilled"),
        (F.col("o_totalprice") > 300000).alias("large"),
    )


def gold_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_rates(
        _orders_flags(spark, sf_dir),
        ["order_date", "o_orderpriority"],
        {"fulfilled_count": "fulfilled", "large_count": "large"},
        count_alias="order_count",
        rate_of=("fulfilled_count", "fulfilled_rate"),
    )


def _lineitem_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").withColumn("ship_date", event_date("l_shipdate"))
    return daily_summary(
        li,
        ["l_returnflag", "ship_date"],
        {"disc_total": ("sum", "l_discount"), "qty_total": ("sum", "l_quantity")},
        count_alias="n_lines",
        exact_scale=2,
    )


def cross_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_mart(
        gold_rate(spark, sf_dir),
        _lineitem_daily(spark, sf_dir),
        fact_date="order_date",
        dim_date="ship_date",
        dim_filter=F.col("l_returnflag") == MART_FLAG,
        sum_cols={"orders": "order_count"},
        attr_cols={"disc_total": "disc_total", "qty_total": "qty_total"},
    )


def windows_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_counts(load(spark, sf_dir, "events"), "ts", ["event_type"], "10 minutes")


# -- Quality ----------------------------------------------------------------

def _dq_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.withColumn(
        "nation_hint", F.when(F.col("c_nationkey") < 20, F.col("c_nationkey"))
    )


def _dq_checks():
    return [
        expect_not_null("c_custkey", "nation_hint"),
        expect_between("c_acctbal", *DQ_ACCTBAL),
        expect_values_in("c_mktsegment", DQ_SEGMENTS),
    ]


def dq_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tag_failures(_dq_input(spark, sf_dir), _dq_checks())
    return tagged.filter(F.size(FAILURES_COL) == 0).drop(FAILURES_COL)


def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tag_failures(_dq_input(spark, sf_dir), _dq_checks())
    return (
        tagged.filter(F.size(FAILURES_COL) > 0)
        .withColumn("dq_reasons", F.array_join(FAILURES_COL, "|"))
        .drop(FAILURES_COL)
    )


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = _dq_checks()
    return suite_metrics(tag_failures(_dq_input(spark, sf_dir), checks), checks)


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def quarantine_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantined rows appended by two runs, the first of them twice (a
    rerun replaces its own rows), read back."""
    path = scratch_path(spark, "quarantine")
    for run_id in ("run-a", "run-b", "run-a"):
        append_run(dq_quarantine(spark, sf_dir), path, run_id)
    return spark.read.parquet(path)


def quality_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which gates let their table through: pass rates and key uniqueness."""
    result = run_suite(_dq_input(spark, sf_dir), _dq_checks())[2]
    lines = load(spark, sf_dir, "lineitem")
    gates = {
        "pass_rate_95": lambda: gate_pass_rate(result, 0.95),
        "pass_rate_50": lambda: gate_pass_rate(result, 0.5),
        "unique_lines": lambda: assert_unique(lines, ["l_orderkey", "l_linenumber"]),
        "unique_orders": lambda: assert_unique(lines, ["l_orderkey"]),
    }
    outcome = []
    for name, gate in gates.items():
        try:
            gate()
            outcome.append((name, "open"))
        except ValueError:
            outcome.append((name, "shut"))
    return spark.createDataFrame(outcome, "gate string, outcome string")


# -- SCD2 -------------------------------------------------------------------

def _order_snapshot(spark: SparkSession, sf_dir: str, start: str | None, end: str) -> DataFrame:
    """Latest order per customer in ``[start, end)`` as an update feed that
    takes effect at ``end``."""
    o = load(spark, sf_dir, "orders")
    cond: Column = F.col("o_orderdate") < F.lit(end).cast("timestamp_ntz")
    if start:
        cond = cond & (F.col("o_orderdate") >= F.lit(start).cast("timestamp_ntz"))
    latest = dedupe_latest(o.filter(cond), ["o_custkey"], "o_orderdate", tie_breakers=["o_orderkey"])
    return latest.select(
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.lit(end).cast("timestamp_ntz").alias("effective_from"),
    )


def _scd2_args() -> dict:
    return {"keys": ["o_custkey"], "tracked": ["o_orderstatus", "o_orderpriority"]}


def scd2_initial_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_initial(_order_snapshot(spark, sf_dir, None, SCD2_CUTOFFS[2]))


def scd2_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = scd2_initial(_order_snapshot(spark, sf_dir, None, SCD2_CUTOFFS[0]))
    updates = _order_snapshot(spark, sf_dir, SCD2_CUTOFFS[0], SCD2_CUTOFFS[2])
    return scd2_merge(first, updates, **_scd2_args())


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merges; the dimension in between is stored by ``is_current``."""
    first = scd2_initial(_order_snapshot(spark, sf_dir, None, SCD2_CUTOFFS[0]))
    second = scd2_merge(first, _order_snapshot(spark, sf_dir, *SCD2_CUTOFFS[:2]), **_scd2_args())
    path = scratch_path(spark, "scd2_dimension")
    second.write.partitionBy("is_current").parquet(path)
    stored = spark.read.schema(second.schema).parquet(path)
    return scd2_merge(stored, _order_snapshot(spark, sf_dir, *SCD2_CUTOFFS[1:]), **_scd2_args())


def scd2_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scd2_upsert`` on feeds that lack the key of some rows: open rows
    without a key stay, updates without one are inserted."""
    key = F.when(F.col("o_orderpriority") != UNKEYED_PRIORITY, F.col("o_custkey"))
    first = _order_snapshot(spark, sf_dir, None, SCD2_CUTOFFS[0]).withColumn("o_custkey", key)
    updates = _order_snapshot(spark, sf_dir, SCD2_CUTOFFS[0], SCD2_CUTOFFS[2]).withColumn("o_custkey", key)
    return scd2_merge(scd2_initial(first), updates, **_scd2_args())


# -- End to end -------------------------------------------------------------

def medallion_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> bronze stamp -> lenient typing -> range repair -> dedupe ->
    quality split -> daily Gold over the good rows. Events of one type are
    delivered a second time with a corrected value, which is the one to keep."""
    deliveries = F.when(F.col("event_type") == REDELIVERED_TYPE, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    delivered = load(spark, sf_dir, "events").withColumn("delivery", F.explode(deliveries))
    raw = delivered.withColumn("value", F.col("value") + F.col("delivery") - 1).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("string").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.col("value").cast("string").alias("value"),
        "delivery",
    )
    bronze = stamp_slice(raw, "events", SLICE_DATE)
    silver = bronze.filter(F.col("user_id").isNotNull() & F.col("ts").isNotNull()).withColumns(
        {
            "user_id": lenient_cast("user_id", "bigint"),
            "ts": lenient_timestamp("ts"),
            "event_type": normalise_key("event_type"),
            "value": null_outside(lenient_cast("value", "double"), *EVENT_VALUE_RANGE),
        }
    )
    silver = dedupe_latest(silver, ["event_id"], "delivery")
    checks = [expect_not_null("user_id", "ts"), expect_between("value", *EVENT_ACCEPTED_RANGE)]
    tagged = tag_failures(silver.withColumn("event_date", event_date("ts")), checks)
    good = tagged.filter(F.size(FAILURES_COL) == 0)
    return daily_summary(
        good,
        ["event_type", "event_date"],
        {"value_avg": ("avg", "value"), "value_max": ("max", "value")},
        count_alias="n_events",
        exact_scale=2,
    )


QUERIES: dict[str, Query] = {
    "bronze_stamp": bronze_stamp,
    "lenient_typing": lenient_typing,
    "normalise_keys": normalise_keys,
    "null_out_of_range": null_out_of_range,
    "dedupe_latest": dedupe_latest_events,
    "dedupe_latest_ties": dedupe_latest_ties,
    "flatten_columnar": flatten_embeddings,
    "gold_daily": gold_daily,
    "gold_rate": gold_rate,
    "cross_mart": cross_mart,
    "windows_batch": windows_batch,
    "dq_good": dq_good,
    "dq_quarantine": dq_quarantine,
    "dq_summary": dq_summary,
    "dq_duplicates": dq_duplicates,
    "scd2_initial": scd2_initial_dim,
    "scd2_upsert": scd2_upsert,
    "scd2_history": scd2_history,
    "scd2_null_keys": scd2_null_keys,
    "quarantine_sink": quarantine_sink,
    "quality_gates": quality_gates,
    "medallion_e2e": medallion_e2e,
}
