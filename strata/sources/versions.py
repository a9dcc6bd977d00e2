"""Catalog tables published as numbered versions behind a view.

A published name is a view on a version table ``{name}__v{number}``. A publish
writes the new files, declares them as the next version table, partitions and
all, and then replaces the view: one catalog operation, whatever changed, so a
reader finds the old version or the new one and never none, with columns
added, dropped or retyped and with other partitions too. Files of earlier
versions are never touched; earlier versions can be read and restored.

The number of a version is taken by creating its table, which fails if it
exists: of two publishers that both build on the same version
(``base``) only one gets through, the other has a :class:`PublishConflict`.

Partitioned versions may share folders: :func:`create_version` takes the
folder of every partition, so a version that changes two dates of a thousand
writes two folders and names the others again. The list of folders (one row
for each partition) is kept beside the files and read by :func:`partitions_of`.

A plain table that has the name already is taken over without dropping it. With
the same columns, or more, and no partitions it stays a table and is pointed at
the new files in one step (a managed table too: its former files stay where
they are). Otherwise it is renamed to version 0, and the name becomes a view
from then on; that first time a reader can find no table between two catalog
operations.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from strata.session import FANOUT_WRITE_CONF, session_conf

VERSION_KEY = "strata.version"
ROOT_KEY = "strata.root"
MANIFEST_KEY = "strata.manifest"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = "values array<string>, location string"
#: Partitions declared by one statement.
_AT_ONCE = 500

#: A partition's values as text (None: NULL) and its folder.
Partition = tuple[tuple[str | None, ...], str]


class PublishConflict(RuntimeError):
    """Another version was published since the one this publish builds on."""


def rebalanced(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spread rows over writer tasks by ``cols`` without pinning one value to
    one task: AQE splits a hot value over several tasks and packs small ones
    together, so a date holding a third of the rows does not become one file
    written by one task."""
    return df.hint("rebalance", *cols) if cols else df


def sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    details = [r["col_name"] for r in rows].index("# Detailed Table Information")
    return {r["col_name"]: r["data_type"] for r in rows[details:]}


def _property(spark: SparkSession, table: str, key: str) -> str | None:
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return found.get(key)


def version_table(table: str, number: int) -> str:
    return f"{table}__v{number:06d}"


def current_version(spark: SparkSession, table: str) -> int | None:
    """The version that ``table`` shows, or None: no such name, or a plain table."""
    if not table_exists(spark, table):
        return None
    number = _property(spark, table, VERSION_KEY) if _described(spark, table)["Type"] == "VIEW" else None
    return int(number) if number else None


def versions(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the versions in the catalog, published or not."""
    db, _, name = table.rpartition(".")
    prefix = f"{name}__v"
    shown = spark.sql(f"SHOW TABLES {'IN ' + db if db else ''} LIKE '{prefix}*'").collect()
    return sorted(int(r["tableName"][len(prefix):]) for r in shown if r["tableName"][len(prefix):].isdigit())


def read_version(spark: SparkSession, table: str, number: int) -> DataFrame:
    """A version's table, with the columns that the view may leave out."""
    return spark.table(version_table(table, number))


def table_location(spark: SparkSession, table: str) -> str | None:
    """The folder of a table, or of the version that the name shows."""
    number = current_version(spark, table)
    return _described(spark, table if number is None else version_table(table, number)).get("Location")


def database_location(spark: SparkSession, table: str) -> str:
    """Folder of the table's database (the warehouse folder for ``default``)."""
    db = table.split(".")[-2] if "." in table else spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(db).locationUri


def version_prefix(table: str) -> str:
    return f"{table.replace('.', '__')}__v"


def versions_root(spark: SparkSession, table: str) -> str | None:
    """The folder that holds the table's version folders."""
    if not table_exists(spark, table):
        return None
    if current_version(spark, table) is not None and (root := _property(spark, table, ROOT_KEY)):
        return root
    current = (table_location(spark, table) or "").rstrip("/")
    parts = current.split("/")
    for i in range(len(parts) - 1, 0, -1):
        if parts[i].startswith(version_prefix(table)):
            return "/".join(parts[:i])
    return current.rsplit("/", 1)[0] if current else None


def new_version_location(spark: SparkSession, table: str, root: str | None = None) -> str:
    """A fresh directory for the next version of ``table``: under ``root``
    when given, else beside the current version, else in the table's
    database folder (shared storage on a cluster)."""
    if root is None:
        root = versions_root(spark, table) or database_location(spark, table)
    return f"{root.rstrip('/')}/{version_prefix(table)}{uuid.uuid4().hex[:12]}"


def write_partitioned(df: DataFrame, location: str, partition_by: Sequence[str]) -> None:
    with session_conf(df.sparkSession, FANOUT_WRITE_CONF):
        rebalanced(df, list(partition_by)).write.mode("errorifexists").partitionBy(*partition_by).parquet(location)


def written_partitions(spark: SparkSession, location: str, partition_by: Sequence[str]) -> list[Partition]:
    """The partitions that Spark's writer made below a folder. Lists one folder
    for each value of the outer columns, and reads no file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(conf)
    found: list[tuple[tuple[str | None, ...], object]] = [((), path)] if fs.exists(path) else []
    for column in partition_by:
        inner = []
        for values, folder in found:
            for status in fs.listStatus(folder):
                child = status.getPath()
                name, _, value = child.getName().partition("=")
                if name == column:
                    # the writer escapes what a folder name cannot hold as %XX
                    inner.append(((*values, None if value == _NULL_FOLDER else unquote(value)), child))
        found = inner
    return [(values, folder.toString()) for values, folder in found]


def partitions_of(spark: SparkSession, table: str, number: int) -> list[Partition]:
    """Every partition of a version and its folder."""
    path = _property(spark, version_table(table, number), MANIFEST_KEY)
    if path is None:
        return []
    return [(tuple(r["values"]), r["location"]) for r in spark.read.schema(_MANIFEST).parquet(path).collect()]


def _columns(fields: Iterable[StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def create_version(
    spark: SparkSession,
    table: str,
    location: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    partitions: Sequence[Partition] | None = None,
    base: int | None = None,
) -> int:
    """Declare files as the next version of ``table``, not yet shown by it.

    ``partitions`` names the folder of each partition; without it those below
    ``location`` are taken. With ``base`` the number has to be the one after
    every version seen now, and a publisher that took it fails this one."""
    if partition_by and partitions is None:
        partitions = written_partitions(spark, location, partition_by)
    number = max([0, *versions(spark, table)]) + 1
    # the schema is declared, not inferred from folder names, which would turn a string value into a date
    ordered = [f for f in schema.fields if f.name not in partition_by] + [schema[c] for c in partition_by]
    keyed = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    manifest = f"{location.rstrip('/')}__partitions-{uuid.uuid4().hex[:8]}"
    noted = f" TBLPROPERTIES ('{MANIFEST_KEY}' = {sql_literal(manifest)})" if partition_by else ""
    if partition_by:
        spark.createDataFrame([(list(v), f) for v, f in partitions], _MANIFEST).coalesce(1).write.parquet(manifest)
    while True:
        own = version_table(table, number)
        try:
            spark.sql(f"CREATE TABLE {own} ({_columns(ordered)}) USING parquet{keyed} LOCATION {sql_literal(location)}{noted}")
            break
        except AnalysisException as err:
            if err.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                raise
            if base is not None:
                raise PublishConflict(f"{table}: version {number} was taken while this one was written") from err
            number += 1
    for at in range(0, len(partitions or ()), _AT_ONCE):
        spec = lambda values: ", ".join(f"`{c}` = {sql_literal(v)}" for c, v in zip(partition_by, values, strict=True))
        some = " ".join(f"PARTITION ({spec(v)}) LOCATION {sql_literal(f)}" for v, f in partitions[at : at + _AT_ONCE])
        spark.sql(f"ALTER TABLE {own} ADD {some}")
    return number


def show_version(
    spark: SparkSession, table: str, number: int, columns: Sequence[str] | None = None, where: str | None = None,
    base: int | None = None, root: str | None = None,
) -> None:
    """Make ``table`` a view of a version, or of the ``columns`` and rows
    (``where``) named, in one catalog operation. With ``base`` the name still
    has to show that version."""
    if base is not None and current_version(spark, table) != base:
        raise PublishConflict(f"{table}: no longer at version {base}")
    own = version_table(table, number)
    names = ", ".join(f"`{c}`" for c in columns or spark.table(own).columns)
    root = root or versions_root(spark, table) or database_location(spark, table)
    moved = False
    if table_exists(spark, table) and current_version(spark, table) is None:
        kind = _described(spark, table)["Type"]
        if kind == "VIEW":
            raise ValueError(f"{table} is a view of something else")
        moved = kind == "MANAGED" and any(c.isPartition for c in spark.catalog.listColumns(table))
        spark.sql(f"ALTER TABLE {table} RENAME TO {version_table(table, 0)}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{VERSION_KEY}' = '{number}', '{ROOT_KEY}' = {sql_literal(root)}) "
        f"AS SELECT {names} FROM {own}" + (f" WHERE {where}" if where else "")
    )
    if moved:  # renaming a managed table moves its folder, but not the entries of its partitions
        spark.sql(f"MSCK REPAIR TABLE {version_table(table, 0)} SYNC PARTITIONS")


def drop_version(spark: SparkSession, table: str, number: int) -> None:
    """Take a version that is not shown out of the catalog; its files stay."""
    if current_version(spark, table) == number:
        raise ValueError(f"{table} shows version {number}")
    spark.sql(f"DROP TABLE IF EXISTS {version_table(table, number)}")


def _repointed(spark: SparkSession, table: str, location: str, schema: StructType) -> bool:
    """Point a plain unpartitioned table at new files of the same columns, or
    more. Files from before read NULL for added columns."""
    if not table_exists(spark, table) or current_version(spark, table) is not None:
        return False
    about = _described(spark, table)
    if about["Type"] == "VIEW" or about.get("Provider", "").lower() != "parquet":
        return False
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        return False
    old = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields]
    new = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if new[: len(old)] != old:
        return False
    if added := schema.fields[len(old) :]:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(added)})")
    spark.sql(f"ALTER TABLE {table} SET LOCATION {sql_literal(location)}")
    spark.catalog.refreshTable(table)
    return True


def publish_version(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    root: str | None = None,
    partition_by: Sequence[str] = (),
    base: int | None = None,
) -> str:
    """Write ``df`` as a new version and make ``table`` show it.

    A run that fails before the switch leaves the table as it was. Returns the
    new version's folder."""
    if base is not None and current_version(spark, table) != base:
        raise PublishConflict(f"{table}: no longer at version {base}")
    location = new_version_location(spark, table, root)
    if partition_by:
        write_partitioned(df, location, partition_by)
    else:
        df.write.mode("errorifexists").parquet(location)
        if base is None and _repointed(spark, table, location, df.schema):
            return location
    number = create_version(spark, table, location, df.schema, partition_by, base=base)
    show_version(spark, table, number, df.columns, base=base, root=root)
    return location


def overwrite_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Full overwrite of a catalog table, optionally date-partitioned. The new
    rows are written to a fresh folder (under ``path`` when given) before the
    name moves, so a failed write leaves the table as it was."""
    publish_version(df.sparkSession, df, table, path, partition_by)


def create_or_replace_as_select(spark: SparkSession, select_sql: str, table: str, root: str | None = None) -> str:
    """``CREATE OR REPLACE TABLE t AS SELECT`` for Parquet tables."""
    return publish_version(spark, spark.sql(select_sql), table, root)
