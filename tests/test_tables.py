import pytest
from pyspark.sql import functions as F

from strata.sources.tables import read_slices, replace_slice, write_slices
from strata.sources.versions import publish_version


def test_replace_slice_is_idempotent_and_empty_clears(spark, scratch):
    path = scratch("bronze")
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, v string")
    b = spark.createDataFrame([("3", "z")], "id string, v string")
    replace_slice(a, path, "_ingest_date", "2026-06-01")
    replace_slice(b, path, "_ingest_date", "2026-06-02")
    replace_slice(a, path, "_ingest_date", "2026-06-01")  # rerun replaces
    got = sorted((r["id"], r["_ingest_date"]) for r in read_slices(spark, path).collect())
    assert got == [("1", "2026-06-01"), ("2", "2026-06-01"), ("3", "2026-06-02")]
    assert replace_slice(a.limit(0), path, "_ingest_date", "2026-06-01") == 0
    got = sorted(r["id"] for r in read_slices(spark, path).collect())
    assert got == ["3"]


def test_schema_evolution_adds_columns(spark, scratch):
    path = scratch("evolve")
    replace_slice(spark.createDataFrame([("1",)], "id string"), path, "_ingest_date", "2026-06-01")
    replace_slice(spark.createDataFrame([("2", "new")], "id string, extra string"), path,
                  "_ingest_date", "2026-06-02")
    rows = {r["id"]: r["extra"] for r in read_slices(spark, path).collect()}
    assert rows == {"1": None, "2": "new"}


def test_write_slices_keeps_other_slices(spark, scratch):
    path = scratch("multi")
    df = spark.createDataFrame([("1", "d1"), ("2", "d2")], "id string, d string")
    write_slices(df, path, "d")
    write_slices(spark.createDataFrame([("9", "d2")], "id string, d string"), path, "d")
    assert sorted(r["id"] for r in read_slices(spark, path).collect()) == ["1", "9"]


def test_publish_version_flips_location(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pubtest LOCATION '{scratch('db')}'")
    t = "pubtest.dim"
    first = publish_version(spark, spark.createDataFrame([(1,)], "x int"), t)
    assert [r["x"] for r in spark.table(t).collect()] == [1]
    # the new version reads the old one while writing
    second = publish_version(spark, spark.table(t).selectExpr("x + 1 AS x"), t)
    assert first != second
    assert [r["x"] for r in spark.table(t).collect()] == [2]
    spark.sql("DROP DATABASE pubtest CASCADE")


def test_catalog_sinks(spark, scratch):
    from strata.sources.tables import append_run, ensure_namespaces
    from strata.sources.versions import create_or_replace_as_select, overwrite_table

    ensure_namespaces(spark, ["sinkdb"])
    ensure_namespaces(spark, ["sinkdb"])  # idempotent
    df = spark.createDataFrame([("2026-06-01", 1), ("2026-06-02", 2)], "d string, x int")
    overwrite_table(df, "sinkdb.silver_t", partition_by=["d"], path=scratch("silver_t"))
    overwrite_table(df.limit(1), "sinkdb.silver_t", partition_by=["d"], path=scratch("silver_t2"))
    assert spark.table("sinkdb.silver_t").count() == 1
    q = scratch("quarantine")
    append_run(df, q, "run-1")
    append_run(df, q, "run-1")  # rerun of the run replaces its rows
    append_run(df, q, "run-2")
    assert spark.read.parquet(q).count() == 4
    create_or_replace_as_select(spark, "SELECT 7 AS x", "sinkdb.mart", root=scratch("mart"))
    create_or_replace_as_select(spark, "SELECT 8 AS x", "sinkdb.mart")
    assert [r.x for r in spark.table("sinkdb.mart").collect()] == [8]
    spark.sql("DROP DATABASE sinkdb CASCADE")


def test_slice_values_stay_strings(spark, scratch):
    from strata.sources.landing import land_batch, read_landing

    path = scratch("slices")
    replace_slice(spark.createDataFrame([("a",)], "v string"), path, "_slice", "0001")
    replace_slice(spark.createDataFrame([("b",)], "v string"), path, "_slice", "2026-06-01")
    got = sorted((r["_slice"], r["v"]) for r in read_slices(spark, path).collect())
    assert got == [("0001", "a"), ("2026-06-01", "b")]
    root = scratch("landing")
    land_batch(spark.createDataFrame([(1,)], "x long"), root, "src", "2026-06-01", "0042")
    assert [r["batch_id"] for r in read_landing(spark, root, "src", "2026-06-01").collect()] == ["0042"]


def test_publish_version_partitioned(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pubpart LOCATION '{scratch('db')}'")
    t = "pubpart.daily"
    v1 = spark.createDataFrame([("2026-06-01", 1), ("2026-06-02", 2)], "d string, x int")
    publish_version(spark, v1, t, partition_by=["d"])
    assert spark.table(t).count() == 2
    v2 = spark.table(t).filter("d = '2026-06-02'").selectExpr("x * 10 AS x", "d")
    publish_version(spark, v2, t, partition_by=["d"])
    assert [(r.d, r.x) for r in spark.table(t).collect()] == [("2026-06-02", 20)]
    spark.sql("DROP DATABASE pubpart CASCADE")


def test_hot_slice_is_split_over_writers(spark, scratch):
    """A slice holding all the rows is written by several tasks (AQE splits
    the rebalance by size), not funnelled into one file."""
    from pyspark.sql import functions as F

    path = scratch("hot")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    previous = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        df = spark.range(0, 400_000, numPartitions=4).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
        assert replace_slice(df, path, "_ingest_date", "2026-06-01") == 400_000
    finally:
        spark.conf.set(key, previous)
    files = read_slices(spark, path).select(F.input_file_name()).distinct().count()
    assert files > 1


def test_publish_carries_the_new_schema(spark, scratch):
    from strata.sources.versions import overwrite_table, table_location, versions_root

    spark.sql(f"CREATE DATABASE IF NOT EXISTS vers LOCATION '{scratch('db')}'")
    t = "vers.dim"
    publish_version(spark, spark.createDataFrame([(1,)], "x int"), t)
    first = table_location(spark, t)
    publish_version(spark, spark.createDataFrame([("two", "new")], "x string, y string"), t)
    assert [tuple(r) for r in spark.table(t).collect()] == [("two", "new")]
    assert table_location(spark, t).startswith(versions_root(spark, t))
    assert spark.read.parquet(first).count() == 1  # the version before keeps its files
    broken = spark.range(1).select(F.raise_error(F.lit("bad input")).cast("string").alias("x"), F.lit("n").alias("y"))
    with pytest.raises(Exception, match="bad input"):
        overwrite_table(broken, t)
    assert [tuple(r) for r in spark.table(t).collect()] == [("two", "new")]
    spark.sql("DROP DATABASE vers CASCADE")


def test_replace_table_slice_atomic_evolving(spark, scratch):
    import pytest

    from strata.sources.tables import replace_table_slice

    spark.sql(f"CREATE DATABASE IF NOT EXISTS slicedb LOCATION '{scratch('db')}'")
    t = "slicedb.bronze"
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, v string")
    replace_table_slice(spark, a, t, "_ingest_date", "2026-06-01")
    replace_table_slice(spark, spark.createDataFrame([("3", "z", "new")], "id string, v string, extra string"),
                        t, "_ingest_date", "2026-06-02")
    replace_table_slice(spark, a.limit(1), t, "_ingest_date", "2026-06-01")  # rerun replaces
    got = sorted((r.id, r.extra, r._ingest_date) for r in spark.table(t).collect())
    assert got == [("1", None, "2026-06-01"), ("3", "new", "2026-06-02")]
    replace_table_slice(spark, a.limit(0), t, "_ingest_date", "2026-06-02")  # empty clears
    assert [r.id for r in spark.table(t).collect()] == ["1"]
    assert spark.table(t).filter("_ingest_date = '2026-06-01'").count() == 1  # partition pruning path
    with pytest.raises(ValueError, match="type change"):
        replace_table_slice(spark, spark.createDataFrame([(1,)], "id int"), t, "_ingest_date", "2026-06-03")
    spark.sql("DROP DATABASE slicedb CASCADE")


def test_load_table_slices_bulk_then_replace(spark, scratch):
    from strata.sources.tables import load_table_slices, replace_table_slice

    spark.sql(f"CREATE DATABASE IF NOT EXISTS bulkdb LOCATION '{scratch('db')}'")
    t = "bulkdb.bronze"
    df = spark.createDataFrame(
        [("1", "2026-06-01"), ("2", "2026-06-01"), ("3", "2026-06-02 10:00")], "id string, d string"
    )
    assert load_table_slices(spark, df, t, "d") == ["2026-06-01", "2026-06-02 10:00"]
    assert sorted((r.id, r.d) for r in spark.table(t).collect()) == [
        ("1", "2026-06-01"), ("2", "2026-06-01"), ("3", "2026-06-02 10:00")]
    replace_table_slice(spark, df.filter("id = '1'"), t, "d", "2026-06-01")
    load_table_slices(spark, spark.createDataFrame([("9", "2026-06-03")], "id string, d string"), t, "d")
    assert sorted(r.id for r in spark.table(t).collect()) == ["1", "3", "9"]
    # a value written as an escaped folder name is replaced, not duplicated
    replace_table_slice(spark, df.filter("id = '2'"), t, "d", "2026-06-02 10:00")
    assert sorted((r.id, r.d) for r in spark.table(t).collect()) == [
        ("1", "2026-06-01"), ("2", "2026-06-02 10:00"), ("9", "2026-06-03")]
    spark.sql("DROP DATABASE bulkdb CASCADE")


def test_setup_is_idempotent(spark, scratch):
    from strata.session import path_exists
    from strata.sources.tables import ensure_folders, ensure_namespaces

    root = scratch("setup")
    for _ in range(2):
        ensure_namespaces(spark, ["setup_bronze", "setup_gold"], root=root)
        paths = ensure_folders(spark, root)
    assert all(path_exists(spark, p) for p in paths) and len(paths) == 3
    assert spark.catalog.getDatabase("setup_gold").locationUri.endswith("/setup_gold")
    for db in ("setup_bronze", "setup_gold"):
        spark.sql(f"DROP DATABASE {db} CASCADE")


def test_two_sliced_tables_in_one_database(spark, scratch):
    """Slices with awkward values; replacing and emptying one table's slices
    leaves the other table's alone."""
    from strata.sources.tables import load_table_slices, replace_table_slice

    spark.sql(f"CREATE DATABASE IF NOT EXISTS two LOCATION '{scratch('db')}'")
    df = spark.createDataFrame([("1", "a"), ("2", "b%2F"), ("3", "c 10:00"), ("4", "d=e/f")], "id string, d string")
    for t in ("two.x", "two.y"):
        assert load_table_slices(spark, df, t, "d") == ["a", "b%2F", "c 10:00", "d=e/f"]
    replace_table_slice(spark, df.filter("id = '4'").withColumn("id", F.lit("9")), "two.x", "d", "c 10:00")
    replace_table_slice(spark, df.filter("false"), "two.x", "d", "d=e/f")
    assert sorted((r.id, r.d) for r in spark.table("two.x").collect()) == [("1", "a"), ("2", "b%2F"), ("9", "c 10:00")]
    assert sorted((r.id, r.d) for r in spark.table("two.y").collect()) == sorted((r.id, r.d) for r in df.collect())
    with pytest.raises(ValueError, match="NULL"):
        load_table_slices(spark, df.withColumn("d", F.lit(None).cast("string")), "two.x", "d")
    assert spark.table("two.x").count() == 3
    spark.sql("DROP DATABASE two CASCADE")
