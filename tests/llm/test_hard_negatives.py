"""Hard negatives against brute force, on rows that pruning reaches."""
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives as hn

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, positives=5, negatives=10, band=(30, 90)):
    """rows: (id, label, vector); every row with an id divisible by 100 asks."""
    last = lambda x: (x is None, x)
    out = []
    for i, (a, label, v) in enumerate(rows):
        if a is None or a % 100:
            continue
        size = lambda w: sum(x * y for x, y in zip(v, w))  # noqa: B023, E731
        others = [(-size(w), last(b), b, lb) for j, (b, lb, w) in enumerate(rows) if j != i]
        for ps, _, p, _ in sorted(x for x in others if x[3] == label)[:positives]:
            fits = sorted(x for x in others if x[3] != label and band[0] * -ps <= 100 * -x[0] <= band[1] * -ps)
            out += [(a, p, n + 1, b, -ps, -ns) for n, (ns, _, b, _) in enumerate(fits[:negatives])]
    return sorted(out, key=repr)


def mined(spark, rows, **args):
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "id long, label long, vector array<long>, part string, score double")
    out = hn.mine_hard_negatives(df, F.col("id") % 100 == 0, **args)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.fixture(scope="module")
def awkward():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(700):
        v = rng.integers(-9, 10, 8) * (rng.random(8) < 0.3)  # few coordinates, so that ranges are narrow
        v = v * int(rng.integers(1, 40) ** 2)  # lengths of all sizes
        rows.append((i * 20 if i % 3 else i, int(rng.choice([1, 1, 1, 2, 3, 4])), [int(x) for x in v]))
    rows += [rows[5], rows[5], rows[0], rows[0]]  # repeated rows, anchors among them
    rows += [(600, 9, [100, 0]), (None, 9, [5, 5, 0, 0, 0, 0, 0, 0]), (None, 8, [3, 0]), (300, 2, []), (400, 3, [10**6, -3, 7]), (500, 4, [1] * 9)]
    return rows


def test_against_brute_force_over_many_tasks_and_waves(spark, awkward):
    want = brute(awkward)
    assert mined(spark, awkward, rows_per_task=60, anchors_per_block=9) == want
    assert len(want) > 500 and any(r[1] is None or r[3] is None for r in want)


def test_one_task_and_other_parameters(spark, awkward):
    assert mined(spark, awkward, positives=2, negatives=3, band=(10, 50)) == brute(awkward, 2, 3, (10, 50))


def test_ranges_prune_and_lose_nothing():
    rng = np.random.default_rng(1)
    rows = rng.integers(-30, 31, (900, 12)) * (rng.random((900, 12)) < 0.25)
    b = hn.Bucket(1, float(np.sqrt((rows**2).sum(1).max())), np.arange(900), np.arange(900), rows)
    anchors = rows[:40] + rng.integers(-2, 3, (40, 12))
    lengths = np.sqrt((anchors**2).sum(1).astype(float))
    least = (0.8 * lengths * b.length).astype(np.int64)
    exact, seen, small = anchors @ rows.T, 0, 0
    for who, cand in hn.candidates(b, anchors, lengths, least):
        cand = np.arange(900) if cand is None else cand
        for a in who:
            assert set(np.flatnonzero(exact[a] >= least[a])) <= set(cand)
            seen, small = seen + 1, small + (len(cand) < 0.2 * 900)
    assert small > 20  # most anchors see a fraction of the bucket
    too_much = (1.01 * lengths * b.length).astype(np.int64) + 1
    assert not list(hn.candidates(b, anchors, lengths, too_much))  # the lengths rule the bucket out


def test_large_components_are_exact(spark):
    big = 2**25 + 1
    rows = [(0, 1, [big, 1]), (1, 1, [big, 2]), (2, 2, [big // 2, 3]), (3, 2, [big // 2, 4])]
    assert mined(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="do not fit a long"):
        mined(spark, [(0, 1, [2**40]), (1, 1, [2**40])])


def test_tables_without_results(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1]), (2, 2, [1])]) == []  # no anchor
    assert mined(spark, [(100, 1, [1]), (2, 2, [1])]) == []  # no positive
    assert mined(spark, [(100, None, [1]), (100, 1, None), (2, 2, [1])]) == []


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    schema = "vec_id long, embedding array<float>, label int, extra string"
    rows = [(1, [0.5, -0.001], 3), (7, [1.0], 9), (14, None, 1), (3, [nan, 1.0], 1), (4, [inf], 1), (5, [None, 1.0], 1), (6, [1.0], None), (None, [0.25], 2)]
    got = hn.scaled_vectors(spark.createDataFrame([(*r, "x") for r in rows], schema)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, 3, [128, -1]), (7, 0, [256]), (None, 2, [64])], key=repr)


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({hn.ORACLE_SQL})").fetchall()
    got = hn.op11_hard_negatives(spark, sf)
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
