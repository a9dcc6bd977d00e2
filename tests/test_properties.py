"""Randomised checks against plain-Python brute force on small inputs."""
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import dedupe
from strata.operators.dedupe import combine_latest, dedupe_latest
from strata.operators.scd2 import scd2_initial, scd2_merge
from strata.session import session_conf

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.sampled_from(["a", "b", "c", None])
vals = st.one_of(st.none(), st.integers(0, 3))


@SETTINGS
@given(st.lists(st.tuples(keys, vals, st.integers(0, 1000)), min_size=0, max_size=25, unique_by=lambda r: r[2]))
def test_dedupe_latest_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, o int, t int")
    got = sorted((r.k or "", r.o, r.t) for r in dedupe_latest(df, ["k"], "o", tie_breakers=["t"]).collect())
    best = {}
    for k, o, t in rows:
        rank = (o is not None, o if o is not None else 0, t)  # NULL order ranks last
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k or "", o, t))
    assert got == sorted(v[1] for v in best.values())


readings = st.sampled_from([None, float("nan"), -1.0, 0.0, 2.5])


@SETTINGS
@given(st.lists(st.tuples(keys, st.sampled_from([0.0, -0.0, 1.0, None]), readings, st.integers(0, 1000)), min_size=0, max_size=60, unique_by=lambda r: r[3]), st.booleans())
def test_combined_rows_give_the_same_latest(spark, monkeypatch, rows, full):
    """Rows are dropped before the sort, but never the latest of a key, also
    with NULLs, NaN, and when a task holds no more and starts again."""
    monkeypatch.setattr(dedupe, "COMBINE_ROWS", 4)
    monkeypatch.setattr(dedupe, "COMBINE_BYTES", 100 if full else 1 << 20)
    df = spark.createDataFrame(rows, "k string, g double, o double, t int").repartition(2)
    with_small = {"spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    with session_conf(spark, with_small):
        some = sorted(map(repr, dedupe_latest(df, ["k", "g"], "o", tie_breakers=["t"], repeated=True).collect()))
        assert len(some) == combine_latest(df, ["k", "g"], ["o", "t"]).select("k", "g").distinct().count()
    assert some == sorted(map(repr, dedupe_latest(df, ["k", "g"], "o", tie_breakers=["t"]).collect()))


T0 = datetime(2026, 1, 1)
dim_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), vals), max_size=4, unique_by=lambda r: r[0])
upd_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "e", None]), vals), max_size=5,
                    unique_by=lambda r: r[0] if r[0] is not None else object())


@SETTINGS
@given(dim_rows, upd_rows)
def test_scd2_merge_matches_brute_force(spark, current, updates):
    schema = "k string, v int, effective_from timestamp"
    t1 = T0 + timedelta(days=1)
    target = scd2_initial(spark.createDataFrame([(k, v, T0) for k, v in current], schema))
    upd = spark.createDataFrame([(k, v, t1) for k, v in updates], schema)
    got = sorted(
        (r.k or "", -1 if r.v is None else r.v, r.effective_from, r.effective_to, r.is_current)
        for r in scd2_merge(target, upd, ["k"], ["v"]).collect()
    )
    expected = []
    open_rows = dict(current)
    for k, v in current:
        u = next((uv for uk, uv in updates if uk == k), "absent")
        changed = u != "absent" and u != v
        expected.append((k, v, T0, t1 if changed else None, not changed))
    for k, v in updates:
        if k is None or k not in open_rows or open_rows[k] != v:
            expected.append((k, v, t1, None, True))
    expected = sorted((k or "", -1 if v is None else v, f, t, c) for k, v, f, t, c in expected)
    assert got == expected


arrays = st.one_of(st.none(), st.lists(st.integers(0, 9), max_size=4))


@SETTINGS
@given(st.lists(st.tuples(arrays, arrays, arrays), max_size=6))
def test_flatten_matches_brute_force(spark, docs):
    from pyspark.sql import functions as F

    from strata.operators.flatten import flatten_columnar

    rows = [(i, t, a, b) for i, (t, a, b) in enumerate(docs)]
    df = spark.createDataFrame(rows, "id int, t array<int>, a array<int>, b array<int>").select(
        "id", F.struct("t", "a", "b").alias("p"))
    order = lambda r: tuple((x is None, x or 0) for x in r)
    got = sorted((tuple(r) for r in flatten_columnar(df, "p", index_field="t", keep=["id"]).collect()), key=order)
    expected = []
    for i, t, a, b in rows:
        for pos, value in enumerate(t or []):
            pick = lambda arr: arr[pos] if arr is not None and pos < len(arr) else None
            expected.append((i, value, pick(a), pick(b)))
    assert got == sorted(expected, key=order)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["x", "y", "z"])),
                          st.one_of(st.none(), st.just(float("nan")), st.floats(-5, 15))), max_size=20))
def test_suite_metrics_match_brute_force(spark, rows):
    from strata.operators.quality import expect_between, expect_not_null, expect_values_in, run_suite

    df = spark.createDataFrame(rows, "k string, v double")
    checks = [expect_not_null("k"), expect_between("v", 0, 10), expect_values_in("k", ["x", "y"])]
    good, quarantine, result = run_suite(df, checks)

    def fails(k, v):
        out = []
        if k is None:
            out.append("not_null(k)")
        if v is not None and not (0 <= v <= 10):  # NaN is outside
            out.append("between(v,0,10)")
        if k is not None and k not in ("x", "y"):
            out.append("values_in(k)")
        return out

    expected = [fails(k, v) for k, v in rows]
    assert result.total_rows == len(rows)
    assert result.passed_rows == sum(1 for f in expected if not f)
    for c in checks:
        assert result.failures_by_check[c.name] == sum(1 for f in expected if c.name in f)
    assert sorted(tuple(r["_dq_failures"]) for r in quarantine.collect()) == sorted(tuple(f) for f in expected if f)
    assert good.count() == result.passed_rows


day = st.sampled_from(["2026-06-01", "2026-06-02", "2026-06-03", None])


@SETTINGS
@given(st.lists(st.tuples(day, st.integers(0, 5)), max_size=8),
       st.lists(st.tuples(day, st.sampled_from(["chicago", "seattle"]), st.integers(0, 9)), max_size=6))
def test_rollup_mart_equals_join_then_group(spark, facts, dims):
    """Same answer as LEFT JOIN + GROUP BY, also when a date has several
    matching dimension rows (the sum is multiplied, as the join would)."""
    from pyspark.sql import functions as F

    from strata.operators.gold import rollup_mart

    f = spark.createDataFrame(facts, "d string, n int")
    w = spark.createDataFrame(dims, "d string, city string, t int")
    got = rollup_mart(f, w, "d", "d", F.col("city") == "chicago", {"total": "n"}, {"t": "t"})
    f.createOrReplaceTempView("facts_v")
    w.createOrReplaceTempView("dims_v")
    sql = spark.sql("""
        SELECT f.d, SUM(f.n) AS total, collect_set(w.t) AS ts
        FROM facts_v f LEFT JOIN dims_v w ON w.city = 'chicago' AND w.d = f.d
        GROUP BY f.d""")
    want = {r.d: (r.total, set(r.ts)) for r in sql.collect()}
    have = {r.d: (r.total, r.t) for r in got.collect()}
    assert set(have) == set(want)
    for d, (total, t) in have.items():
        assert total == want[d][0]
        assert (t is None and not want[d][1]) or t in want[d][1]  # ANY_VALUE picks one of them
