"""Checkpointed drain-and-stop stream runs, and the two-hop event stream.

Every run uses ``trigger(availableNow=True)``: it processes everything that
has arrived (in bounded micro-batches when the source caps files per
trigger), runs the trailing batch that emits windows the final watermark
closed, and stops. A scheduler re-runs it; offsets, commits and state live in
the checkpoint folder, so a rerun continues where the last run stopped and a
lost executor only repeats the current micro-batch.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.sources.tables import add_new_columns
from strata.streaming.sources import (
    DEFAULT_MAX_FILES_PER_TRIGGER,
    read_json_stream,
    resolve_schema,
)
from strata.streaming.windows import watermarked_window_counts


@dataclass
class RunStats:
    batches: int = 0
    input_rows: int = 0
    dropped_by_watermark: int = 0
    progress: list = field(default_factory=list)


def stats(query: StreamingQuery) -> RunStats:
    out = RunStats()
    for p in query.recentProgress:
        out.batches += 1
        out.input_rows += int(p.numInputRows or 0)
        for op in p.stateOperators or []:
            out.dropped_by_watermark += int(op.numRowsDroppedByWatermark or 0)
        out.progress.append(p)
    return out


def run_available_now(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    output_mode: str = "append",
    fmt: str = "parquet",
    state_partitions: int | None = None,
) -> RunStats:
    """Drain ``df`` into a Parquet folder (``path``) or a catalog table
    (``table``, created at ``path`` when given) and stop.

    ``state_partitions`` sets how many shuffle partitions (and state stores)
    a stateful query gets. The number is fixed in the checkpoint on the
    first run, so it only matters then; the session setting is restored as
    soon as the query has started (the stream runs on its own copy)."""
    writer = (
        df.writeStream.format(fmt)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    spark = df.sparkSession
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        if table:
            if path:
                writer = writer.option("path", path)
            query = writer.toTable(table)
        else:
            query = writer.start(path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(f"stream failed: {query.exception()}")
    return stats(query)


def read_table_stream(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table as a stream source (new files as they are committed)."""
    return spark.readStream.table(table)


@dataclass
class TwoHopPaths:
    """Folders of the two-hop stream. With table names, Bronze and Gold are
    also catalog tables (at those folders) and hop 2 reads Bronze as a
    table stream."""
    landing: str
    bronze: str
    gold: str
    checkpoints: str
    bronze_table: str | None = None
    gold_table: str | None = None

    @property
    def schema_location(self) -> str:
        return f"{self.checkpoints}/source_schema"


def stream_pass(
    spark: SparkSession,
    paths: TwoHopPaths,
    ts_col: str,
    keys: Sequence[str],
    required: Sequence[str],
    hints_ddl: str | None = None,
    size: str = "10 minutes",
    delay: str = "15 minutes",
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
    *,
    state_partitions: int,
    evolve_schema: bool = True,
) -> tuple[RunStats, RunStats]:
    """One scheduled pass: landing files -> Bronze (append) -> windowed Gold.

    Hop 1 stamps ``_ingested_at`` / ``_source_file`` and appends to Bronze; a
    line that cannot be read as the schema says keeps its text in ``_rescued``.
    Hop 2 streams Bronze's committed files, drops rows missing a required
    field, and appends closed windows to Gold. The window state is spread
    over ``state_partitions`` state stores. The first run fixes that width for
    the life of the checkpoint, so choose it for the largest cluster and state
    expected, not for today's. With ``evolve_schema`` the landing
    files are re-inferred and new fields are appended to the persisted
    schema; Bronze files written earlier read NULL for them.
    """
    schema = resolve_schema(
        spark, paths.landing, hints_ddl, paths.schema_location, evolve=evolve_schema
    )
    bronze_stream = read_json_stream(spark, paths.landing, schema, max_files_per_trigger)
    bronze_schema = bronze_stream.schema
    if paths.bronze_table and spark.catalog.tableExists(paths.bronze_table):
        add_new_columns(spark, paths.bronze_table, bronze_schema)  # evolved fields
    hop1 = run_available_now(
        bronze_stream, f"{paths.checkpoints}/bronze", path=paths.bronze, table=paths.bronze_table
    )

    if paths.bronze_table:
        silver = read_table_stream(spark, paths.bronze_table)
    else:
        silver = spark.readStream.schema(bronze_schema).parquet(paths.bronze)
    cond = None
    for c in required:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    if cond is not None:
        silver = silver.filter(cond)
    gold = watermarked_window_counts(silver, ts_col, keys, size, delay)
    hop2 = run_available_now(
        gold, f"{paths.checkpoints}/gold", path=paths.gold, table=paths.gold_table,
        state_partitions=state_partitions,
    )
    return hop1, hop2
