from strata.sources.landing import ingest_bronze, land_batch, read_landing
from strata.sources.tables import read_slices


def test_land_read_and_rerun(spark, scratch):
    root, bronze = scratch("landing"), scratch("bronze")
    df = spark.createDataFrame([(1, 2.5), (2, None)], "id long, v double")
    land_batch(df, root, "src", "2026-06-01", "b1")
    land_batch(df, root, "src", "2026-06-01", "b1")  # same batch id replaces
    raw = read_landing(spark, root, "src", "2026-06-01")
    assert raw.count() == 2
    assert dict(raw.dtypes)["id"] == "string"  # bronze stays string-typed
    assert all(r["_source_file"].endswith(".json") for r in raw.collect())
    assert ingest_bronze(spark, root, "src", bronze, "2026-06-01") == 2
    assert ingest_bronze(spark, root, "src", bronze, "2026-06-01") == 2
    out = read_slices(spark, bronze).collect()
    assert len(out) == 2
    assert {r["_batch_id"] for r in out} == {"src-2026-06-01"}
    assert {r["_ingest_date"] for r in out} == {"2026-06-01"}


def test_missing_date_is_an_empty_batch(spark, scratch):
    raw = read_landing(spark, scratch("landing"), "src", "2026-01-01")
    assert raw.count() == 0


def test_multiline_payload_documents_flatten(spark, scratch):
    """One API payload document per file (a JSON object spanning lines), read
    with multi_line and pivoted to hourly rows."""
    import json
    import os

    from strata.plans.weather import flatten_hourly

    root = scratch("landing")
    folder = f"{root}/weather/ingest_date=2026-06-02/batch_id=b1".removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    docs = {
        "chicago.json": {"city": "chicago", "hourly": {"time": ["2026-06-01T00:00", "2026-06-01T01:00"],
                                                       "temperature_2m": [21.5, 20.9],
                                                       "precipitation": [0.0]}},
        "seattle.json": {"city": "seattle", "hourly": {"time": ["2026-06-01T00:00"],
                                                       "temperature_2m": [12.0],
                                                       "precipitation": [0.4]}},
    }
    for name, doc in docs.items():
        with open(f"{folder}/{name}", "w") as fh:
            fh.write(json.dumps(doc, indent=2))
    raw = read_landing(spark, root, "weather", "2026-06-02", multi_line=True,
                       schema="city string, hourly struct<time: array<string>, "
                              "temperature_2m: array<double>, precipitation: array<double>>")
    rows = sorted((r.city, r.observed_at, r.temperature_2m, r.precipitation)
                  for r in flatten_hourly(raw.select("city", "hourly")).collect())
    assert rows == [
        ("chicago", "2026-06-01T00:00", 21.5, 0.0),
        ("chicago", "2026-06-01T01:00", 20.9, None),
        ("seattle", "2026-06-01T00:00", 12.0, 0.4),
    ]


def test_ingest_bronze_table_replaces_and_evolves(spark, scratch):
    from strata.sources.landing import ingest_bronze_table

    spark.sql(f"CREATE DATABASE IF NOT EXISTS bronzedb LOCATION '{scratch('db')}'")
    root, t = scratch("landing"), "bronzedb.events"
    land_batch(spark.createDataFrame([(1,), (2,)], "id long"), root, "src", "2026-06-01", "b1")
    ingest_bronze_table(spark, root, "src", t, "2026-06-01")
    ingest_bronze_table(spark, root, "src", t, "2026-06-01")  # rerun replaces
    land_batch(spark.createDataFrame([(3, "new")], "id long, extra string"), root, "src", "2026-06-02", "b2")
    ingest_bronze_table(spark, root, "src", t, "2026-06-02")
    rows = sorted((r.id, r.extra, r._ingest_date, r._batch_id) for r in spark.table(t).collect())
    assert rows == [("1", None, "2026-06-01", "src-2026-06-01"), ("2", None, "2026-06-01", "src-2026-06-01"),
                    ("3", "new", "2026-06-02", "src-2026-06-02")]
    spark.sql("DROP DATABASE bronzedb CASCADE")


def test_arrays_over_lines_need_multi_line(spark, scratch):
    import os

    import pytest

    root, bronze = scratch("landing"), scratch("bronze")
    folder = f"{root}/src/ingest_date=2026-06-03/batch_id=b1".removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/a.json", "w") as fh:
        fh.write('[\n  {"id": 1},\n  {"id": 2}\n]\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest_bronze(spark, root, "src", bronze, "2026-06-03")
    assert ingest_bronze(spark, root, "src", bronze, "2026-06-03", multi_line=True) == 2
    assert sorted(r["id"] for r in read_slices(spark, bronze).collect()) == ["1", "2"]
