"""Publishing versions: whatever changes, a reader always finds a table."""
import threading

import pytest
from pyspark.sql import functions as F

from strata.session import path_exists
from strata.sources import versions as v


@pytest.fixture()
def db(spark, scratch, request):
    name = f"ver_{request.node.name[:30].lower()}".replace("[", "_").replace("]", "")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch('db')}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_reader_never_fails_while_the_schema_changes(spark, db):
    t = f"{db}.t"
    shapes = [
        (spark.createDataFrame([(1, "a")], "x int, y string"), ()),
        (spark.createDataFrame([(1, "a", 2.5)], "x int, y string, z double"), ()),  # added
        (spark.createDataFrame([("one", 7)], "x string, y int"), ()),  # retyped, dropped
        (spark.createDataFrame([("one", "2026-06-01"), ("two", None)], "x string, d string").withColumn("d", F.to_date("d")), ("d",)),  # partitioned
        (spark.createDataFrame([(3.5, True)], "x double, p boolean"), ("p",)),  # other partitions
        (spark.createDataFrame([(1, "a")], "x int, y string"), ()),
    ]
    v.publish_version(spark, shapes[0][0], t)
    errors, reads, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                got = spark.table(t).collect()
                reads.append(len(got))
            except Exception as err:  # noqa: BLE001
                errors.append(err)

    reader = threading.Thread(target=read)
    reader.start()
    for df, by in shapes * 2:
        v.publish_version(spark, df, t, partition_by=by)
        assert rows(spark.table(t).select(*df.columns)) == rows(df)
        assert spark.table(t).schema.simpleString() == df.schema.simpleString()
    stop.set()
    reader.join()
    assert not errors and len(reads) > 5 and min(reads) >= 1
    assert v.current_version(spark, t) == 13 and len(v.versions(spark, t)) == 13
    assert rows(v.read_version(spark, t, 1)) == [(1, "a")]  # earlier versions stay readable
    v.show_version(spark, t, 3)
    assert rows(spark.table(t)) == [(1, "a", 2.5)] and v.current_version(spark, t) == 3


def test_partitions_are_pruned_through_the_view(spark, db):
    df = spark.range(60).select("id", F.concat(F.lit("2026-06-"), F.lpad((F.col("id") % 3 + 1).cast("string"), 2, "0")).cast("date").alias("d"))
    v.publish_version(spark, df, f"{db}.t", partition_by=["d"])
    one = spark.table(f"{db}.t").where("d = date'2026-06-02'")
    assert one.count() == 20 and len(one.inputFiles()) < len(spark.table(f"{db}.t").inputFiles())


def test_failed_publish_changes_nothing(spark, db):
    v.publish_version(spark, spark.createDataFrame([(1,)], "x int"), f"{db}.t")
    broken = spark.range(1).select(F.raise_error(F.lit("bad input")).cast("string").alias("x"))
    with pytest.raises(Exception, match="bad input"):
        v.publish_version(spark, broken, f"{db}.t")
    assert rows(spark.table(f"{db}.t")) == [(1,)] and v.versions(spark, f"{db}.t") == [1]


def test_publishers_on_the_same_base(spark, db):
    t = f"{db}.t"
    v.publish_version(spark, spark.createDataFrame([(1,)], "x int"), t)
    v.publish_version(spark, spark.createDataFrame([(2,)], "x int"), t, base=1)
    with pytest.raises(v.PublishConflict):
        v.publish_version(spark, spark.createDataFrame([(3,)], "x int"), t, base=1)
    # another publisher takes the number while this one writes
    slow = spark.createDataFrame([(4,)], "x int")
    location = v.new_version_location(spark, t)
    slow.write.parquet(location)
    taken, real = [], v.versions

    def seen_late(spark_, table):
        found = real(spark_, table)
        if not taken:
            taken.append(1)
            v.create_version(spark, t, location, slow.schema, base=2)
        return found

    v.versions = seen_late
    try:
        with pytest.raises(v.PublishConflict, match="was taken"):
            v.create_version(spark, t, location, slow.schema, base=2)
    finally:
        v.versions = real
    assert rows(spark.table(t)) == [(2,)]


def test_managed_table_is_overwritten_in_place(spark, db):
    t = f"{db}.m"
    spark.range(3).write.saveAsTable(t)
    files = spark.table(t).inputFiles()
    v.overwrite_table(spark.range(5, 7), t)
    assert rows(spark.table(t)) == [(5,), (6,)] and v.current_version(spark, t) is None
    v.overwrite_table(spark.range(1).withColumn("more", F.lit("m")), t)  # a column more: still the same table
    assert rows(spark.table(t)) == [(0, "m")]
    assert spark.read.parquet(*files).count() == 3


def test_managed_table_of_another_shape_becomes_version_0(spark, db):
    t = f"{db}.m"
    spark.createDataFrame([(1, "p"), (2, "q")], "x int, d string").write.partitionBy("d").saveAsTable(t)
    v.overwrite_table(spark.createDataFrame([("a", "p")], "x string, d string"), t, partition_by=["d"])
    assert rows(spark.table(t)) == [("a", "p")] and v.current_version(spark, t) == 1
    assert rows(v.read_version(spark, t, 0)) == [(1, "p"), (2, "q")]
    v.overwrite_table(spark.createDataFrame([(True,)], "x boolean"), t)
    assert rows(spark.table(t)) == [(True,)]


def test_a_view_of_something_else_is_left_alone(spark, db):
    spark.sql(f"CREATE VIEW {db}.w AS SELECT 1 AS x")
    with pytest.raises(ValueError, match="view of something else"):
        v.publish_version(spark, spark.range(2), f"{db}.w")
    assert rows(spark.table(f"{db}.w")) == [(1,)]


def test_empty_versions_and_dropped_entries(spark, db):
    t = f"{db}.t"
    empty = spark.createDataFrame([], "x int, d date")
    v.publish_version(spark, empty, t, partition_by=["d"])
    assert spark.table(t).count() == 0 and v.partitions_of(spark, t, 1) == []
    v.publish_version(spark, spark.createDataFrame([(1,)], "x int"), t)
    with pytest.raises(ValueError, match="shows version"):
        v.drop_version(spark, t, 2)
    location = v._described(spark, v.version_table(t, 1))["Location"]
    v.drop_version(spark, t, 1)
    assert v.versions(spark, t) == [2] and path_exists(spark, location)


def test_partition_values_that_folders_escape(spark, db, scratch):
    values = ["plain", "10:00", "a/b=c%2F", "é ü", "{x}", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "x int, d string")
    v.publish_version(spark, df, f"{db}.t", partition_by=["d"])
    assert rows(spark.table(f"{db}.t")) == rows(df)
    assert sorted((x for (x,), _ in v.partitions_of(spark, f"{db}.t", 1)), key=repr) == sorted(values, key=repr)


def test_a_folder_slice_with_an_escaped_value_is_emptied(spark, scratch):
    from strata.sources.tables import read_slices, replace_slice

    path, df = scratch("hours"), spark.createDataFrame([(1,), (2,)], "x int")
    for value in ("10:00", "11:00", "a%b"):
        replace_slice(df, path, "at", value)
    for value in ("10:00", "a%b"):
        replace_slice(df.where("false"), path, "at", value)
    assert rows(read_slices(spark, path)) == [(1, "11:00"), (2, "11:00")]
