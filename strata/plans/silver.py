"""The Silver step: transform, check, gate, then publish; whole or for what changed.

A Silver version holds the winning row of every key, the passing and the
failing ones, partitioned by verdict and date. The Silver table is a view of
the passing half. Nothing is shown before the gates have passed.

:func:`silver_step` recomputes Silver from all of Bronze. :func:`silver_refresh`
recomputes the keys that changed Bronze slices touch, and writes again only the
dates on which such a key has a row before or after; the next version names the
folders of all other dates as they are. Both give the same table.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import all_present
from strata.operators.quality import FAILURES_COL, Check, SuiteResult, assert_unique, gate_pass_rate, suite_result, tag_failures
from strata.session import scratch_path
from strata.sources.tables import append_run
from strata.sources.versions import (
    create_version,
    current_version,
    drop_version,
    new_version_location,
    partitions_of,
    read_version,
    show_version,
    write_partitioned,
    written_partitions,
)

# Fixed value that must stay as it is for results to match: the pass rate that Silver needs.
MIN_PASS_RATE = 0.95
PASSED_COL = "_dq_passed"


@dataclass
class SilverRun:
    result: SuiteResult
    good: DataFrame
    quarantine: DataFrame
    #: Dates written by a refresh; None: all of them.
    dates: list | None = None


def _judged(silver: DataFrame, checks: Sequence[Check]) -> DataFrame:
    return tag_failures(silver, checks).withColumn(PASSED_COL, F.size(FAILURES_COL) == 0)


def _silver_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (FAILURES_COL, PASSED_COL)]


def silver_step(
    spark: SparkSession,
    bronze: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    checks: Sequence[Check],
    unique_keys: Sequence[str],
    silver_table: str,
    partition_col: str,
    quarantine_path: str,
    run_id: str,
    min_pass_rate: float | None = MIN_PASS_RATE,
    root: str | None = None,
) -> SilverRun:
    """Transform, check, gate, then publish a date-partitioned Silver table.

    The transformed rows are computed and written exactly once. The staged
    version cuts the lineage (metrics, uniqueness, publish and quarantine all
    read the same files, so they agree even when the transform is not
    deterministic or a task was run again) and is itself the published table,
    so Silver is not written a second time after a checkpoint. The metrics
    read the column of failed checks alone.
    """
    judged = _judged(transform(bronze), checks)
    location = new_version_location(spark, silver_table, root)
    write_partitioned(judged, location, [PASSED_COL, partition_col])
    staged = spark.read.schema(judged.schema).parquet(location)
    result = suite_result(staged, checks)
    good = staged.filter(F.col(PASSED_COL)).drop(PASSED_COL, FAILURES_COL)
    quarantine = staged.filter(~F.col(PASSED_COL)).drop(PASSED_COL)

    assert_unique(good, unique_keys)
    if min_pass_rate is not None:
        gate_pass_rate(result, min_pass_rate)
    number = create_version(spark, silver_table, location, judged.schema, [PASSED_COL, partition_col])
    show_version(spark, silver_table, number, _silver_columns(judged), PASSED_COL, root=root)
    if result.quarantined_rows:
        append_run(quarantine, quarantine_path, run_id)
    return SilverRun(result, good, quarantine)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def touched_keys(bronze: DataFrame, state: DataFrame, changed: Sequence[str], keys: Mapping[str, Column], slice_col: str) -> DataFrame:
    """Keys that changed slices deliver now, and those whose winning row came
    from what the slices held before. A row that a slice lost without having
    been the winner changes nothing."""
    in_changed = F.col(slice_col).isin(list(changed))
    delivered = bronze.where(in_changed).select(*[e.alias(k) for k, e in keys.items()])
    held = state.where(in_changed).select(*keys)
    return delivered.unionByName(held).where(all_present(*keys)).distinct()


def silver_refresh(
    spark: SparkSession,
    bronze: DataFrame,
    changed: Sequence[str],
    keys: Mapping[str, Column],
    transform: Callable[[DataFrame], DataFrame],
    checks: Sequence[Check],
    unique_keys: Sequence[str],
    silver_table: str,
    partition_col: str,
    quarantine_path: str,
    run_id: str,
    min_pass_rate: float | None = MIN_PASS_RATE,
    root: str | None = None,
    slice_col: str = "_ingest_date",
) -> SilverRun:
    """Bring Silver up to date with Bronze slices that were added or replaced.

    ``changed`` names the slices, ``keys`` gives each Silver key as an
    expression over Bronze columns; the transform must drop rows without a key
    and keep ``slice_col``. Gates see the whole next version, quarantine gets
    the failing rows among the recomputed ones. Silver is rebuilt whole where
    there is none yet, or where the transform now gives a column another type.

    Bronze is read once through a semi-join with the touched keys: broadcast
    while they are few, by AQE's measure. Rows of Silver are read on touched
    dates only, their keys everywhere.
    """
    base = current_version(spark, silver_table)
    rebuild = dict(
        transform=transform, checks=checks, unique_keys=unique_keys, silver_table=silver_table, partition_col=partition_col,
        quarantine_path=quarantine_path, run_id=run_id, min_pass_rate=min_pass_rate, root=root,
    )
    if base is None:
        return silver_step(spark, bronze, **rebuild)
    state = read_version(spark, silver_table, base)
    types = {f.name: f.dataType for f in state.schema.fields}
    if PASSED_COL not in types or any(types.get(f.name, f.dataType) != f.dataType for f in transform(bronze).schema.fields):
        return silver_step(spark, bronze, **rebuild)
    if slice_col not in types:
        raise ValueError(f"{silver_table} has no column {slice_col}: a refresh cannot tell where its rows came from")

    if not changed:
        failed = state.where(~F.col(PASSED_COL)).drop(PASSED_COL)
        return SilverRun(suite_result(state, checks), spark.table(silver_table), failed, [])

    touched = _kept(touched_keys(bronze, state, changed, keys, slice_col), "touched")
    asked = touched.select(*[F.col(k).alias(f"_touched_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [e == F.col(f"_touched_{k}") for k, e in keys.items()])
    winners = _kept(_judged(transform(bronze.join(asked, same, "left_semi")), checks), "winners")
    before = state.join(touched, list(keys), "left_semi").select(partition_col)
    dates = [r[0] for r in before.unionByName(winners.select(partition_col)).distinct().collect()]  # at most a row for each partition
    on_dates = F.col(partition_col).isin([d for d in dates if d is not None])
    if None in dates:
        on_dates = on_dates | F.col(partition_col).isNull()
    stays = state.where(on_dates).join(touched, list(keys), "left_anti")
    rows = stays.unionByName(winners, allowMissingColumns=True)
    location = new_version_location(spark, silver_table, root)
    by = [PASSED_COL, partition_col]
    write_partitioned(rows, location, by)
    rewritten = {None if d is None else str(d) for d in dates}
    carried = [(values, folder) for values, folder in partitions_of(spark, silver_table, base) if values[1] not in rewritten]
    partitions = carried + written_partitions(spark, location, by)
    number = create_version(spark, silver_table, location, rows.schema, by, partitions, base=base)
    try:
        after = read_version(spark, silver_table, number)
        result = suite_result(after, checks)
        # rows that were not touched were unique before, by the same keys
        unique_of = winners if set(unique_keys) == set(keys) else after
        assert_unique(unique_of.where(F.col(PASSED_COL)), unique_keys)
        if min_pass_rate is not None:
            gate_pass_rate(result, min_pass_rate)
        show_version(spark, silver_table, number, _silver_columns(rows), PASSED_COL, base=base, root=root)
    except Exception:
        if current_version(spark, silver_table) != number:
            drop_version(spark, silver_table, number)
        raise
    failed = winners.where(~F.col(PASSED_COL)).drop(PASSED_COL)
    if not failed.isEmpty():
        append_run(failed, quarantine_path, run_id)
    return SilverRun(result, spark.table(silver_table), failed, dates)
