"""Exactly-once micro-batch sink: each batch is a slice that can be written again.

A batch goes to ``{path}/_stream={query id}/_batch={n}`` and replaces what
stands there. A batch that runs twice, as after a driver that died between the
write and the commit, leaves its rows once. The query id comes from the
checkpoint, so a stream started afresh never overwrites what another wrote.
The sink keeps no log of its files, which would grow for ever: the folder is
read like any partitioned table.

A batch that is being written is not committed yet. :func:`committed_batches`
leaves it out; a reader that runs after the drain can read the folder as it is.
"""
from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.session import path_exists, session_conf
from strata.streaming.sinks import RunStats, stats

STREAM_COL, BATCH_COL = "_stream", "_batch"
BATCH_FIELDS = [StructField(STREAM_COL, StringType()), StructField(BATCH_COL, LongType())]


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """Id of the stream that owns a checkpoint; None before its first run."""
    file = f"{checkpoint.rstrip('/')}/metadata"
    if not path_exists(spark, file):
        return None
    return json.loads("".join(r[0] for r in spark.read.text(file).collect()))["id"]  # one line


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """Number of the newest committed batch, -1 if there is none. Spark keeps
    the last hundred or so commit files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return -1
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return max((int(n) for n in names if n.isdigit()), default=-1)


def run_batches(
    df: DataFrame,
    checkpoint: str,
    path: str,
    output_mode: str = "append",
    state_partitions: int | None = None,
    before_write: Callable[[DataFrame, int], DataFrame] | None = None,
) -> RunStats:
    """Drain ``df`` into slices under ``path`` and stop. ``before_write`` may
    change a batch's rows; it must give the same rows when the batch runs again.

    A folder written by Spark's own file sink is refused: readers of such a
    folder see only the files in its log, so slices beside it would be lost."""
    spark = df.sparkSession
    root = path.rstrip("/")
    if path_exists(spark, f"{root}/_spark_metadata"):
        raise ValueError(f"{path} belongs to a file sink with a log of its own")
    taken = {STREAM_COL, BATCH_COL} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are names of the sink's partitions")

    def write(batch: DataFrame, number: int) -> None:
        owner = query_id(batch.sparkSession, checkpoint)
        rows = before_write(batch, number) if before_write else batch
        rows.write.mode("overwrite").parquet(f"{root}/{STREAM_COL}={owner}/{BATCH_COL}={number}")

    writer = (
        df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(write)
    )
    # the stream runs on its own copy of the settings, taken at the start
    with session_conf(spark, {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}):
        query = writer.start()
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(f"stream failed: {query.exception()}")
    return stats(query)


def batch_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields, *BATCH_FIELDS])


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All slices under ``path`` with ``_stream`` and ``_batch``. The schema is
    given, so no footer is read for it; a column that a slice lacks is NULL."""
    full = batch_schema(schema)
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def committed_batches(df: DataFrame, checkpoint: str) -> DataFrame:
    """Rows of ``df`` without the slice that the stream of ``checkpoint`` may
    be writing just now (a filter of partitions)."""
    spark = df.sparkSession
    owner = query_id(spark, checkpoint)
    if owner is None:
        return df
    return df.where((F.col(STREAM_COL) != owner) | (F.col(BATCH_COL) <= last_committed(spark, checkpoint)))
