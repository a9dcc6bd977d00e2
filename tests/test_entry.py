import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["event_type", "event_date", "value_avg", "value_max", "n_events"]


def test_every_oracle_has_a_query():
    qs, sql = entry.queries(), entry.oracle_sql()
    own = {n for n in qs if n not in entry.LLM_QUERIES}
    assert own <= set(sql) <= set(qs)  # every query of the library itself has oracle SQL
    assert len(qs) >= 43


# a row limit is only allowed where it is the feature (one page of a reader)
LIMIT_IS_THE_FEATURE = {"keyset_page", "page_by_number"}
# broadcast hints only on data with a proven bound (one row per partition)
BOUNDED_BROADCAST = {"paged_read"}


def test_every_query_runs_on_smallest_fixture(spark):
    for name, fn in entry.queries().items():
        if name in entry.LLM_QUERIES:
            continue  # run by tests/llm
        df = fn(spark, "/root/testdata/sf0.001")
        assert df.count() >= 0, name
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        if name not in LIMIT_IS_THE_FEATURE:  # (WindowGroupLimit is top-1 per key, not a cap)
            assert "GlobalLimit" not in plan and "LocalLimit" not in plan, name
            assert "Sample" not in plan, name
        if name not in BOUNDED_BROADCAST:
            assert "BROADCAST" not in plan.upper(), name
        # no Python in the hot path, no cross joins
        assert "PythonUDF" not in plan and "pythonUDF" not in plan, name
        assert "Join Cross" not in plan and "Cartesian" not in plan, name
