"""Text-first stream, exactly-once slices, late rows."""
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.streaming.batches import committed_batches, last_committed, read_batches, run_batches
from strata.streaming.late import corrected_windows
from strata.streaming.lines import (
    KnownFields,
    bronze_fields,
    gold_windows,
    lines_pass,
    parse_lines,
    read_lines,
    take_up_fields,
    taken_up,
)
from strata.streaming.sinks import TwoHopPaths

HINTS = "ride BIGINT, dock STRING, at TIMESTAMP"
ARGS = dict(ts_col="at", keys=["dock"], required=["ride", "at"], hints_ddl=HINTS, state_partitions=2)


def _paths(base):
    return TwoHopPaths(f"{base}/landing", f"{base}/bronze", f"{base}/gold", f"{base}/ckpt")


def _land(spark, paths, lines):
    texts = [(x if isinstance(x, str) else json.dumps(x),) for x in lines]
    spark.createDataFrame(texts, "value string").coalesce(1).write.mode("append").text(paths.landing)


def _ride(i, hhmm, dock="north", **more):
    return {"ride": i, "dock": dock, "at": f"2025-03-09T{hhmm}:00", **more}


def _bronze(spark, paths):
    return read_lines(spark, paths.bronze, KnownFields(spark, paths.schema_location).schema())


def test_parse_keeps_every_field(spark):
    lines = [
        '{"a": 1, "b": "x"}', '{"a": 2, "c": {"d": [1, 2]}, "e": null, "A": 7}', '{"a": "two", "f": 1.50}',
        '{"a": 3, "b"', "[1, 2]", '[{"a": 4}]', '"text"', "{}",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, value string")
    schema = spark.createDataFrame([], "a bigint, b string").schema
    rows = {r["i"]: r for r in parse_lines(df, schema).collect()}
    assert (rows[0]["a"], rows[0]["b"], rows[0]["_extra"], rows[0]["_rescued"]) == (1, "x", None, None)
    assert rows[1]["a"] == 2 and rows[1]["_extra"] == {"c": '{"d":[1,2]}', "e": None, "A": "7"}
    assert rows[2]["a"] is None and rows[2]["_rescued"] == lines[2] and rows[2]["_extra"] == {"f": "1.5"}
    for i in (3, 4, 5, 6):
        assert rows[i]["_rescued"] == lines[i], lines[i]
    assert rows[7]["_rescued"] is None and rows[7]["_extra"] is None
    nothing_known = parse_lines(df.where("i = 0"), spark.createDataFrame([], "a int").drop("a").schema).collect()[0]
    assert nothing_known["_extra"] == {"a": "1", "b": "x"}


def test_a_field_that_comes_after_the_schema_is_in_bronze(spark, scratch):
    paths = _paths(scratch("lines"))
    _land(spark, paths, [_ride(1, "08:00"), "", "   "])
    lines_pass(spark, paths, **ARGS)
    # the fields known are those of the first pass while these lines are read
    _land(spark, paths, [_ride(2, "08:01", bike="cargo", _batch=9, Dock="x"), _ride(3, "08:02")])
    hop1, _ = lines_pass(spark, paths, **ARGS)
    assert hop1.input_rows == 2
    schema = KnownFields(spark, paths.schema_location).schema()
    assert [f.name for f in taken_up(schema)] == ["bike"]
    held = read_batches(spark, paths.bronze, bronze_fields(schema)).where("ride = 2").first()
    assert held["bike"] is None and held["_extra"] == {"bike": "cargo", "_batch": "9", "Dock": "x"}
    _land(spark, paths, [_ride(4, "08:03", bike="city", lights=True)])
    lines_pass(spark, paths, **ARGS)
    rows = {r["ride"]: r for r in _bronze(spark, paths).collect()}
    assert {i: r["bike"] for i, r in rows.items()} == {1: None, 2: "cargo", 3: None, 4: "city"}
    assert rows[4]["lights"] == "true" and rows[4]["_extra"] is None
    assert rows[2]["_extra"] == {"_batch": "9", "Dock": "x"} and rows[2]["_rescued"] is None
    assert all(r["_source_file"] and r["_ingested_at"] for r in rows.values())


def test_filters_of_first_fields_reach_the_scan(spark, scratch):
    paths = _paths(scratch("pushed"))
    _land(spark, paths, [_ride(1, "08:00", bike="b")])
    lines_pass(spark, paths, **ARGS)
    plan = _bronze(spark, paths).where("ride > 5").select("dock")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ride,5)" in plan and "_extra" not in plan.split("ReadSchema")[1]


def test_taking_up_is_by_frequency_and_typed_by_hints(spark):
    rows = [({"n": "5", "often": "x"},), ({"n": "x", "often": "y", " ": "z"},), (None,)]
    bronze = spark.createDataFrame(rows, "_extra map<string,string>")
    from strata.session import scratch_path

    known = KnownFields(spark, scratch_path(spark, "fields"))
    assert [f.name for f in take_up_fields(bronze, known, max_fields=1).fields] == ["n"]
    schema = take_up_fields(bronze, known, "often INT, other INT", min_rows=2)
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [("n", "string"), ("often", "int")]
    assert take_up_fields(bronze, known) == schema  # a blank name is never a column


def test_two_passes_that_take_up_fields_both_keep_theirs(spark, scratch):
    path = scratch("known")
    one, two = KnownFields(spark, path), KnownFields(spark, path)
    fields = {n: spark.createDataFrame([], f"{n} string").schema.fields for n in "abc"}
    one.add(fields["a"])
    two.add(fields["b"])
    assert one.add(fields["c"]).fieldNames() == ["a", "b", "c"]
    number = one.ledger.last()[0]
    one.add(fields["b"])
    assert one.ledger.last()[0] == number  # nothing new, no commit


def _lose_commit(checkpoint):
    """What a driver leaves that dies between a batch's write and its commit."""
    n = max(int(f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    for f in (str(n), f".{n}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{f}"):
            os.remove(f"{checkpoint}/commits/{f}")
    return n


def test_a_batch_run_twice_leaves_its_rows_once(spark, scratch):
    base = scratch("twice")
    base = base.removeprefix("file:")
    src, out, ck = f"{base}/in", f"{base}/out", f"{base}/ck"
    spark.createDataFrame([("a",), ("b",)], "value string").coalesce(1).write.mode("append").text(src)
    stream = lambda: spark.readStream.text(src)
    schema = stream().schema
    run_batches(stream(), ck, out)
    spark.createDataFrame([("c",)], "value string").coalesce(1).write.mode("append").text(src)
    run_batches(stream(), ck, out)
    lost = _lose_commit(ck)
    assert last_committed(spark, ck) == lost - 1
    everything = read_batches(spark, out, schema)
    assert sorted(r["value"] for r in committed_batches(everything, ck).collect()) == ["a", "b"]
    run_batches(stream(), ck, out)
    assert sorted(r["value"] for r in read_batches(spark, out, schema).collect()) == ["a", "b", "c"]
    assert last_committed(spark, ck) == lost and not os.path.exists(f"{out}/_spark_metadata")
    # a stream started afresh adds its own slices beside them
    run_batches(stream(), f"{base}/ck2", out)
    again = read_batches(spark, out, schema)
    assert again.count() == 6 and again.select("_stream").distinct().count() == 2
    assert read_batches(spark, f"{base}/none", schema).count() == 0


def test_foreign_folders_and_clashing_names_are_refused(spark, scratch):
    base = scratch("foreign")
    spark.createDataFrame([("a",)], "value string").write.text(f"{base}/in")
    stream = spark.readStream.text(f"{base}/in")
    stream.writeStream.format("parquet").option("checkpointLocation", f"{base}/c0").trigger(availableNow=True).start(f"{base}/out").awaitTermination()
    with pytest.raises(ValueError, match="log of its own"):
        run_batches(stream, f"{base}/c1", f"{base}/out")
    with pytest.raises(ValueError, match="_batch"):
        run_batches(stream.withColumn("_batch", F.lit(1)), f"{base}/c2", f"{base}/out2")


def test_late_rows_are_kept_and_correct_their_windows(spark, scratch):
    base = scratch("late")
    paths, late = _paths(base), f"{base}/late"
    args = {**ARGS, "late_path": late}
    _land(spark, paths, [_ride(1, "11:00"), _ride(2, "11:05"), _ride(3, "11:30"), {"dock": "north", "at": "2025-03-09T11:01:00"}])
    lines_pass(spark, paths, **args)
    _land(spark, paths, [_ride(4, "11:02"), _ride(5, "11:12"), _ride(6, "11:50"), _ride(7, "11:03", "south"), {"dock": "north", "at": "2025-03-09T11:04:00"}])
    _, hop2 = lines_pass(spark, paths, **args)
    assert hop2.dropped_by_watermark == 2
    schema = KnownFields(spark, paths.schema_location).schema()
    assert sorted(r["ride"] for r in read_lines(spark, late, schema).collect()) == [4, 7]
    lines_pass(spark, paths, **args)  # nothing new: nothing is kept twice
    assert read_lines(spark, late, schema).count() == 2

    def counted(df):
        return sorted((r["window_start"].strftime("%H:%M"), r["dock"], r["event_count"]) for r in df.collect())

    assert counted(gold_windows(spark, paths, "at", ["dock"], HINTS)) == [("11:00", "north", 2), ("11:10", "north", 1)]
    corrected = gold_windows(spark, paths, "at", ["dock"], HINTS, late_path=late)
    assert counted(corrected) == [("11:00", "north", 3), ("11:00", "south", 1), ("11:10", "north", 1)]


def test_corrections_of_an_empty_gold(spark):
    gold = spark.createDataFrame([], "window_start timestamp, window_end timestamp, dock string, event_count bigint")
    late = spark.createDataFrame([("n", datetime(2025, 3, 9, 11, 2)), ("n", datetime(2025, 3, 9, 11, 3))], "dock string, at timestamp")
    rows = corrected_windows(gold, late, "at", ["dock"], "10 minutes").collect()
    assert [(r["dock"], r["event_count"]) for r in rows] == [("n", 2)]
    assert corrected_windows(gold, late.limit(0), "at", ["dock"], "10 minutes").count() == 0


def test_an_empty_landing_folder_is_an_empty_pass(spark, scratch):
    paths = _paths(scratch("nothing").removeprefix("file:"))
    os.makedirs(paths.landing)
    os.makedirs(paths.bronze)
    hop1, _ = lines_pass(spark, paths, **ARGS)
    assert hop1.input_rows == 0 and _bronze(spark, paths).count() == 0


def test_station_pass_by_lines(spark, scratch):
    from strata.plans.medallion import station_lines_pass

    paths = _paths(scratch("station_lines"))
    ride = {"trip_id": "r1", "station_id": "K7", "event_type": "dock", "event_ts": "2025-03-09T11:00:00+00:00", "app": "web"}
    _land(spark, paths, [ride, {**ride, "trip_id": "r2", "event_ts": "2025-03-09T12:00:00+00:00"}, {**ride, "trip_id": None}])
    hop1, hop2 = station_lines_pass(spark, paths, state_partitions=2)
    assert (hop1.input_rows, hop2.dropped_by_watermark) == (3, 0)
    gold = spark.read.parquet(paths.gold).collect()
    assert [(r["station_id"], r["event_type"], r["event_count"]) for r in gold] == [("K7", "dock", 1)]
    assert [r["app"] for r in _bronze(spark, paths).collect()] == ["web"] * 3
