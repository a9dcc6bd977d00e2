"""Silver refreshed for changed slices equals Silver computed whole."""
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import expect_between
from strata.plans.crimes import silver_crimes
from strata.plans.medallion import crimes_checks, crimes_keys
from strata.plans.silver import PASSED_COL, silver_refresh, silver_step
from strata.sources import versions as v
from strata.sources.tables import read_slices, replace_slice

FIELDS = ["case_number", "date", "updated_on", "primary_type", "arrest", "domestic", "latitude", "longitude", "iucr", "description"]
SCHEMA = ", ".join(f"{f} string" for f in FIELDS) + ", _ingested_at timestamp, _source_file string"
ARGS = dict(transform=silver_crimes, checks=crimes_checks(), unique_keys=["case_number"], partition_col="occurred_date", min_pass_rate=None)


def update(case, day, updated, kind="theft", arrest="true"):
    return (case, day, updated, kind, arrest, "false", "41.8", "-87.7", "0001", "over", None, f"f-{case}-{updated}")


@pytest.fixture()
def lake(spark, scratch, request):
    name = f"ref_{request.node.name[:40].lower()}".split("[")[0]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch('db')}'")
    folder = scratch("bronze")

    class Lake:
        db, path, quarantine = name, folder, scratch("quarantine")

        def put(self, day, rows):
            replace_slice(spark.createDataFrame(rows, SCHEMA), folder, "_ingest_date", day)

        def bronze(self):
            return read_slices(spark, folder)

        def refresh(self, changed, run="r", **more):
            args = ARGS | more
            return silver_refresh(spark, self.bronze(), changed, crimes_keys(), silver_table=f"{name}.silver", quarantine_path=self.quarantine, run_id=run, **args)

        def whole(self, **more):
            table = f"{name}.whole"
            silver_step(spark, self.bronze(), silver_table=table, quarantine_path=scratch("q"), run_id="w", **(ARGS | more))
            return table

        def both_equal(self, **more):
            whole = self.whole(**more)
            for a, b in ((f"{name}.silver", whole),):
                cols = sorted(spark.table(b).columns)
                got, want = (sorted(map(repr, spark.table(t).select(*cols).collect())) for t in (a, b))
                assert got == want
                held = [sorted(map(repr, v.read_version(spark, t, v.current_version(spark, t)).select(*cols, PASSED_COL).collect())) for t in (a, b)]
                assert held[0] == held[1]  # the failing winners too

    yield Lake()
    spark.sql(f"DROP DATABASE {name} CASCADE")


def folders(spark, table):
    return {values: folder for values, folder in v.partitions_of(spark, table, v.current_version(spark, table))}


def test_refresh_by_hand(spark, lake):
    t = f"{lake.db}.silver"
    lake.put("d1", [update("a1", "2026-06-01T10:00", "2026-06-02"), update("A2", "2026-06-02T10:00", "2026-06-03"), update("a3", "2026-06-03T10:00", "2026-06-03"), update("a4", "2026-06-04T10:00", "2026-06-03")])
    assert lake.refresh(["d1"]).dates is None  # the first one is whole
    first = folders(spark, t)
    # a1 moves to another date, A2 gets an older update, a5 is new, a6 fails
    lake.put("d2", [update("a1", "2026-06-05T10:00", "2026-06-09"), update("a2", "2026-06-07T10:00", "2026-06-01"), update("a5", "2026-06-03T11:00", "2026-06-04"), update("a6", "no date", "2026-06-04")])
    run = lake.refresh(["d2"])
    lake.both_equal()
    assert sorted(map(str, run.dates)) == ["2026-06-01", "2026-06-02", "2026-06-03", "2026-06-05", "None"]
    assert (run.result.total_rows, run.result.quarantined_rows) == (6, 1)
    second = folders(spark, t)
    untouched = ("true", "2026-06-04")
    assert second[untouched] == first[untouched]  # the date keeps its files
    assert ("true", "2026-06-01") not in second and second[("true", "2026-06-03")] != first[("true", "2026-06-03")]
    assert spark.read.parquet(lake.quarantine).count() == 1


def test_replaced_and_emptied_slices(spark, lake):
    lake.put("d1", [update("a1", "2026-06-01T10:00", "2026-06-02", "old"), update("a2", "2026-06-01T10:00", "2026-06-02"), update("a3", "bad", "2026-06-01"), update("a3", "2026-06-02T10:00", "2026-05-01")])
    lake.put("d2", [update("a1", "2026-06-03T10:00", "2026-06-05", "new"), update("a3", "bad too", "2026-06-04"), update("a9", "2026-06-09T10:00", "2026-06-04")])
    lake.refresh(["d1", "d2"])
    lake.put("d2", [update("a2", "2026-06-01T12:00", "2026-06-08", "later")])  # a1, a3, a9 are gone from it
    lake.refresh(["d2"])
    lake.both_equal()
    lake.put("d1", [])
    lake.refresh(["d1"])
    lake.both_equal()
    assert [r["case_number"] for r in spark.table(f"{lake.db}.silver").collect()] == ["A2"]
    before = v.current_version(spark, f"{lake.db}.silver")
    assert lake.refresh([]).dates == [] and v.current_version(spark, f"{lake.db}.silver") == before
    lake.put("d2", [])
    lake.refresh(["d2"])
    assert spark.table(f"{lake.db}.silver").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_random_loads_equal_a_full_recompute(spark, lake, seed):
    rng = random.Random(seed)

    def some(n):
        return [
            update(rng.choice(["c", "C", " c"]) + str(rng.randint(1, 12)) if rng.random() < 0.9 else None, rng.choice([f"2026-06-0{rng.randint(1, 6)}T10:00", "bad", None]), f"2026-07-{rng.randint(10, 28)}", str(rng.random()))
            for _ in range(n)
        ]

    for n in range(4):
        changed = rng.sample(["s1", "s2", "s3"], rng.randint(1, 2))
        for s in changed:
            lake.put(s, some(rng.randint(0, 15)))
        lake.refresh(changed, f"r{n}")
        lake.both_equal()


def test_a_closed_gate_leaves_the_table(spark, lake):
    t = f"{lake.db}.silver"
    lake.put("d1", [update(f"a{i}", "2026-06-01T10:00", "2026-06-02") for i in range(4)])
    lake.refresh(["d1"], min_pass_rate=0.95)
    lake.put("d2", [update(f"b{i}", "never", "2026-06-02") for i in range(4)])
    with pytest.raises(ValueError, match="quality gate"):
        lake.refresh(["d2"], min_pass_rate=0.95)
    assert v.current_version(spark, t) == 1 and v.versions(spark, t) == [1] and spark.table(t).count() == 4
    lake.refresh(["d2"], min_pass_rate=0.5)
    lake.both_equal()


def test_new_and_retyped_columns(spark, lake):
    lake.put("d1", [update("a1", "2026-06-01T10:00", "2026-06-02"), update("a2", "2026-06-02T10:00", "2026-06-02")])
    lake.refresh(["d1"])
    wider = spark.createDataFrame([(*update("a1", "2026-06-01T11:00", "2026-06-05"), "12")], SCHEMA + ", beat string")
    replace_slice(wider, lake.path, "_ingest_date", "d2")
    assert lake.refresh(["d2"]).dates is not None
    lake.both_equal()
    retyped = lambda df: silver_crimes(df).withColumn("beat", F.expr("try_cast(beat as int)"))
    assert lake.refresh(["d2"], transform=retyped).dates is None  # written whole
    lake.both_equal(transform=retyped)


def test_the_plan_reads_only_touched_dates(spark, lake):
    lake.put("d1", [update(f"a{i}", f"2026-06-{i:02d}T10:00", "2026-06-02") for i in range(1, 20)])
    lake.refresh(["d1"], checks=[*crimes_checks(), expect_between("latitude", 41, 43)])
    before = folders(spark, f"{lake.db}.silver")
    lake.put("d2", [update("a7", "2026-06-07T12:00", "2026-06-09")])
    run = lake.refresh(["d2"], checks=[*crimes_checks(), expect_between("latitude", 41, 43)])
    after = folders(spark, f"{lake.db}.silver")
    assert [str(d) for d in run.dates] == ["2026-06-07"]
    assert {k for k in before if before[k] != after.get(k)} == {("true", "2026-06-07")}
