from datetime import datetime

from pyspark.sql import functions as F

from strata.functions.columns import (
    differs_null_safe,
    lenient_cast,
    lenient_timestamp,
    normalise_key,
    null_outside,
)
from strata.operators.flatten import flatten_map_payload


def test_lenient_typing_never_fails(spark):
    df = spark.createDataFrame([("2026-06-01T10:00", "1.5", "yes"), ("garbage", "abc", "2")],
                               "t string, d string, b string")
    rows = df.select(
        lenient_timestamp("t").alias("t"), lenient_cast("d", "double").alias("d"),
        lenient_cast("b", "boolean").alias("b"),
        lenient_timestamp(F.lit("01/06/2026"), "dd/MM/yyyy").alias("f"),
    ).collect()
    assert rows[0]["t"] == datetime(2026, 6, 1, 10, 0) and rows[0]["d"] == 1.5 and rows[0]["b"] is True
    assert rows[1]["t"] is None and rows[1]["d"] is None and rows[1]["b"] is None
    assert rows[0]["f"] == datetime(2026, 6, 1)


def test_normalise_trims_spaces_only(spark):
    df = spark.createDataFrame([("  hy100 ",), ("\thy100",)], "k string")
    assert [r.k for r in df.select(normalise_key("k").alias("k")).collect()] == ["HY100", "\tHY100"]


def test_null_outside_and_null_safe_difference(spark):
    df = spark.createDataFrame([(5.0, "a", "a"), (float("nan"), None, None), (11.0, "a", None)],
                               "v double, x string, y string")
    rows = df.select(
        null_outside("v", 0, 10).alias("v"),
        differs_null_safe([F.col("x")], [F.col("y")]).alias("d"),
    ).collect()
    assert [r.v for r in rows] == [5.0, None, None]
    assert [r.d for r in rows] == [False, False, True]


def test_flatten_map_payload(spark):
    df = spark.createDataFrame(
        [(1, {"time": [0.0, 1.0], "a": [10.0, 11.0], "b": [7.0]})],
        "id int, payload map<string, array<double>>",
    )
    rows = flatten_map_payload(df, "payload", ["a", "b", "c"], keep=["id"]).collect()
    assert [(r.id, r.time, r.a, r.b, r.c) for r in rows] == [(1, 0.0, 10.0, 7.0, None), (1, 1.0, 11.0, None, None)]
