from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.sources.incremental import (
    HighWaterMarks,
    advance_cursor,
    assign_pages,
    date_window,
    keyset_page,
    load_date_window,
    read_since,
)


def test_cursor_strict_and_inclusive(spark):
    df = spark.createDataFrame([(1, "2026-06-01"), (2, "2026-06-02"), (3, "2026-06-03")],
                               "id int, u string").withColumn("u", F.to_date("u"))
    assert [r.id for r in read_since(df, "u", "2026-06-02").collect()] == [3]
    assert sorted(r.id for r in read_since(df, "u", "2026-06-02", inclusive=True).collect()) == [2, 3]
    assert advance_cursor(read_since(df, "u", "2026-06-03"), "u", "keep") == "keep"
    assert advance_cursor(df, "u", None) == date(2026, 6, 3)


def test_date_window_rules(spark, scratch):
    assert date_window("2026-06-05", "2026-06-06") is None
    assert date_window("2026-06-01", "2026-06-06") == (date(2026, 6, 1), date(2026, 6, 4))
    df = spark.createDataFrame([("2026-06-02",)], "d string").withColumn("d", F.to_date("d"))
    marks = HighWaterMarks(spark, scratch("hwm"))
    landed = scratch("landed")

    def lost(rows):
        raise OSError("disk full")

    with pytest.raises(OSError):
        load_date_window(df, "d", marks, "w", "2026-06-01", "2026-06-06", lost)
    assert marks.get("w", "none") == "none"  # the window is still to be loaded
    window = load_date_window(df, "d", marks, "w", "2026-06-01", "2026-06-06", lambda rows: rows.write.parquet(landed))
    assert window == (date(2026, 6, 1), date(2026, 6, 4)) and marks.get("w", "") == "2026-06-05"
    assert spark.read.parquet(landed).count() == 1
    with pytest.raises(ValueError, match="no rows"):
        load_date_window(df, "d", marks, "w", "2026-06-01", "2026-06-09", lambda rows: rows.write.parquet(landed))
    assert marks.get("w", "") == "2026-06-05"  # a window without rows leaves the mark


def test_keyset_pages_cover_everything(spark):
    df = spark.range(0, 250).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    seen, after = [], None
    while True:
        page = keyset_page(df, ["a", "b"], 40, after).collect()
        seen += [(r.a, r.b) for r in page]
        if len(page) < 40:
            break
        after = (page[-1].a, page[-1].b)
    assert seen == sorted((r.a, r.b) for r in df.collect())


def test_assign_pages_matches_row_number(spark):
    df = spark.range(0, 1000).select((F.col("id") % 13).alias("a"), F.col("id").alias("b"))
    got = {(r.a, r.b): (r.row_ordinal, r.page_no) for r in assign_pages(df, ["a", "b"], 100, 4).collect()}
    w = Window.orderBy("a", "b")
    ref = df.withColumn("n", F.row_number().over(w) - 1).collect()
    assert got == {(r.a, r.b): (r.n, r.n // 100) for r in ref}


def test_keyset_walk_over_null_keys(spark):
    """NULL keys sort first and every row is met once."""
    rows = [(None if i % 3 == 0 else i % 4, None if i == 5 else i) for i in range(40)]
    df = spark.createDataFrame(rows, "a int, b int")
    seen, after = [], None
    while page := keyset_page(df, ["a", "b"], 7, after).collect():
        seen += [(r.a, r.b) for r in page]
        after = seen[-1]
    assert len(seen) == 40 and sorted(seen, key=str) == sorted(rows, key=str)


def test_page_by_number_equals_offset_limit(spark):
    from strata.sources.incremental import page_by_number

    df = spark.range(0, 500).select((F.col("id") % 11).alias("a"), F.col("id").alias("b"))
    got = [(r.a, r.b) for r in page_by_number(df, ["a", "b"], 40, 3).orderBy("a", "b").collect()]
    want = [(r.a, r.b) for r in df.orderBy("a", "b").offset(120).limit(40).collect()]
    assert got == want


def test_page_by_number_divides_ranges_until_they_are_small(spark):
    import random

    from strata.sources.incremental import page_by_number

    rng = random.Random(3)
    # a third of the rows share the first key, some have none
    keys = [("hot" if i % 3 == 0 else None if i % 17 == 0 else f"k{rng.randrange(50):02d}", i * 7919 % 5003, i % 5 / 3) for i in range(5003)]
    df = spark.createDataFrame(keys, "a string, b long, c double").repartition(5)
    order = sorted(keys, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    for page in (0, 1, 7, 49, 50, 51):
        got = page_by_number(df, ["a", "b"], 100, page, sorted_rows=150).orderBy("row_ordinal").collect()
        want = order[page * 100 : (page + 1) * 100]
        assert [(r["a"], r["b"], r["c"]) for r in got] == want, page
        assert [r["row_ordinal"] for r in got] == list(range(page * 100, page * 100 + len(want)))
        assert all(r["page_no"] == page for r in got)
    plan = page_by_number(df, ["a", "b"], 100, 7, sorted_rows=150)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_page_by_number_on_times_ties_and_nothing(spark):
    import pytest

    from strata.sources.incremental import page_by_number

    df = spark.sql("select timestamp_millis(id * 977) as t, cast(t as timestamp_ntz) as n, id / 7 as d, id from range(400)")
    for cols in (["t"], ["n"], ["d", "id"]):
        assert [r["id"] for r in page_by_number(df, cols, 30, 3, sorted_rows=60).orderBy("row_ordinal").collect()] == list(range(90, 120))
    same = spark.range(500).selectExpr("1 as a")
    assert page_by_number(same, ["a"], 40, 12, sorted_rows=10).count() == 20
    empty = page_by_number(df.where("id < 0"), ["id"], 10, 0)
    assert empty.count() == 0 and empty.columns[-2:] == ["row_ordinal", "page_no"]
    with pytest.raises(ValueError, match="binary"):
        page_by_number(spark.sql("select binary('x') as b"), ["b"], 1, 0)
