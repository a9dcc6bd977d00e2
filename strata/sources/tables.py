"""Table writes without a transactional table format.

What a transactional table format gives Bronze/Silver/Gold jobs is re-expressed on plain
Parquet directories and the session catalog:

* slice replacement (``replaceWhere``): dynamic partition overwrite of the
  slice partition; Spark stages the new files and swaps the partition in at
  commit. A replacement with zero rows clears the slice explicitly, because a
  dynamic overwrite that writes nothing leaves the old files in place.
* schema evolution (``mergeSchema`` on write): every slice keeps the schema it
  was written with; readers merge the footers, so an older slice reads NULL
  for a column added later. Bronze stays string-typed, so a type clash cannot
  arise from type inference drifting between batches.
* whole-table replacement while readers may read the old version (MERGE /
  ``CREATE OR REPLACE``): numbered versions behind a view, see
  ``strata.sources.versions``.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import FANOUT_WRITE_CONF, scratch_path, session_conf
from strata.sources.versions import database_location, rebalanced, sql_literal, table_exists, version_prefix, versions_root, written_partitions


MEDALLION_NAMESPACES = ("bronze", "silver", "gold", "landing", "ops")


# the file areas beside the tables: raw landing, the stream drop zone and
# stream checkpoints
MEDALLION_FOLDERS = ("landing/raw", "landing/events", "ops/checkpoints")


def ensure_namespaces(
    spark: SparkSession, names: Sequence[str] = MEDALLION_NAMESPACES, root: str | None = None
) -> None:
    """Idempotent namespace setup; with ``root`` each namespace keeps its
    tables in ``{root}/{name}``."""
    for name in names:
        location = f" LOCATION '{root.rstrip('/')}/{name}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{location}")


def ensure_folders(spark: SparkSession, root: str, folders: Sequence[str] = MEDALLION_FOLDERS) -> list[str]:
    """Idempotent creation of the file areas under ``root`` (any Hadoop
    file system). Returns their paths."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = []
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{folder}")
        path.getFileSystem(conf).mkdirs(path)
        paths.append(path.toString())
    return paths


def write_slices(df: DataFrame, path: str, slice_col: str, single_slice: bool = False) -> int:
    """Write (or rewrite) every slice present in ``df``; slices not present
    keep their files. Returns the number of rows written.

    Rows are rebalanced by the slice column so each slice's files come from
    few tasks; when all rows share one slice that would only funnel them
    together, so they are rebalanced by size alone."""
    obs = Observation(f"slices_{uuid.uuid4().hex[:8]}")
    balanced = df.hint("rebalance") if single_slice else rebalanced(df, [slice_col])
    counted = balanced.observe(obs, F.count(F.lit(1)).alias("rows"))
    with session_conf(df.sparkSession, {} if single_slice else FANOUT_WRITE_CONF):
        (
            counted.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(slice_col)
            .parquet(path)
        )
    return int(obs.get.get("rows", 0))


def replace_slice(df: DataFrame, path: str, slice_col: str, slice_value: str) -> int:
    """Replace exactly the slice ``slice_col = slice_value`` with ``df``.

    Every row is stamped with the slice value, so no row can land in another
    slice. A rerun replaces instead of duplicating; an empty ``df`` leaves an
    empty slice. Returns the number of rows written.
    """
    stamped = df.withColumn(slice_col, F.lit(slice_value))
    rows = write_slices(stamped, path, slice_col, single_slice=True)
    if rows == 0:
        spark = df.sparkSession
        empty = spark.createDataFrame([], df.drop(slice_col).schema)
        empty.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_folder_name(spark, slice_col, slice_value)}")
    return rows


def _folder_name(spark: SparkSession, slice_col: str, slice_value: str) -> str:
    """The folder name that Spark's writer gives a slice (``10:00`` becomes
    ``10%3A00``), taken from a row written elsewhere."""
    path = scratch_path(spark, "slice-name")
    row = spark.range(1).select("id", F.lit(slice_value).cast("string").alias(slice_col))
    row.write.partitionBy(slice_col).parquet(path)
    ((_, folder),) = written_partitions(spark, path, [slice_col])
    return folder.rsplit("/", 1)[1]


@contextmanager
def string_partition_values(spark: SparkSession) -> Iterator[None]:
    """Resolve partition directories with string values while the relation
    is created: inference would turn ``0001`` into 1 and dates into dates."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    previous = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, previous)


def read_slices(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """Read a sliced table, merging the schemas the slices were written with.
    Slice values come back exactly as written, as strings."""
    with string_partition_values(spark):
        return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def append_run(df: DataFrame, path: str, run_id: str, run_col: str = "_run_id") -> int:
    """Append-only sink (quarantine) that stays idempotent per run: the rows
    of one run form one partition, so rerunning the run replaces them."""
    return write_slices(df.withColumn(run_col, F.lit(run_id)), path, run_col, single_slice=True)


def add_new_columns(spark: SparkSession, table: str, schema: StructType) -> list[str]:
    """Evolve ``table`` to accept ``schema``: fields it lacks are appended
    (existing files read NULL for them); a field whose type differs is
    rejected rather than silently recast. Returns the added names."""
    current = {f.name: f.dataType for f in spark.table(table).schema.fields}
    clashes = [f.name for f in schema.fields if f.name in current and current[f.name] != f.dataType]
    if clashes:
        raise ValueError(f"type change for {clashes} in {table}; Bronze fields should stay strings")
    added = [f for f in schema.fields if f.name not in current]
    if added:
        spark.sql(
            f"ALTER TABLE {table} ADD COLUMNS ("
            + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            + ")"
        )
        spark.catalog.refreshTable(table)
    return [f.name for f in added]


def replace_table_slice(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    slice_col: str,
    slice_value: str,
    root: str | None = None,
) -> str:
    """Atomic slice replacement for a catalog table partitioned by ``slice_col``.

    The slice's rows are written to a fresh directory, then the partition is
    pointed at it with one catalog operation, so a reader sees either the old
    slice or the new one, never a half-written or missing slice, and a failed
    write leaves the table untouched. Zero rows give an empty slice. Fields
    new to the table are added to its schema (older slices read NULL for
    them); a field whose type changed is rejected. Returns the slice's new
    directory.
    """
    if slice_value is None:
        raise ValueError("a slice value must not be NULL")
    rows = df.drop(slice_col) if slice_col in df.columns else df
    if not table_exists(spark, table):
        base = root or database_location(spark, table)
        location = f"{base.rstrip('/')}/{version_prefix(table)}{uuid.uuid4().hex[:12]}"
        columns = ", ".join(
            [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
            + [f"`{slice_col}` string"]
        )
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({slice_col}) "
            f"LOCATION '{location}'"
        )
    else:
        add_new_columns(spark, table, rows.schema)
    root_dir = versions_root(spark, table) or database_location(spark, table)
    slice_dir = f"{root_dir}/{version_prefix(table)}slices/{uuid.uuid4().hex}"
    rows.hint("rebalance").write.mode("errorifexists").parquet(slice_dir)
    _point_partitions(spark, table, slice_col, {str(slice_value): slice_dir})
    return slice_dir


def _point_partitions(spark: SparkSession, table: str, slice_col: str, locations: dict[str, str]) -> None:
    """Register partitions that are new (all in one statement), then point
    each one at its folder. The catalog itself resolves the values."""
    spec = lambda value: f"PARTITION ({slice_col} = {sql_literal(value)})"
    if locations:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"{spec(v)} LOCATION '{loc}'" for v, loc in locations.items()))
    for value, location in locations.items():
        spark.sql(f"ALTER TABLE {table} {spec(value)} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def load_table_slices(
    spark: SparkSession, df: DataFrame, table: str, slice_col: str, root: str | None = None
) -> list[str]:
    """Bulk form of :func:`replace_table_slice`: every slice present in
    ``df`` is written by ONE job (rebalanced by slice, hot slices split),
    then each of those partitions is pointed at its new folder. Slices not
    in ``df`` are untouched. Returns the slice values written."""
    if not df.filter(F.col(slice_col).isNull()).isEmpty():
        raise ValueError(f"{slice_col} must not be NULL")
    if not table_exists(spark, table):
        replace_table_slice(spark, df.limit(0), table, slice_col, "__init__", root)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({slice_col} = '__init__')")
    root_dir = versions_root(spark, table) or database_location(spark, table)
    load_dir = f"{root_dir}/{version_prefix(table)}load{uuid.uuid4().hex[:12]}"
    with session_conf(spark, FANOUT_WRITE_CONF):
        (
            rebalanced(df, [slice_col]).write.mode("errorifexists")
            .partitionBy(slice_col).parquet(load_dir)
        )
    folders = {values[0]: folder for values, folder in written_partitions(spark, load_dir, [slice_col])}
    _point_partitions(spark, table, slice_col, folders)
    return sorted(folders)


