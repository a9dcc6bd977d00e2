"""Late rows kept: what the watermark dropped, and the windows it belongs to.

A windowed stream drops a row whose window had closed before the row's batch.
Which rows those were follows from the checkpoint: the source log says which
Bronze slices a batch read, the offset log which watermark was in force. The
dropped rows are read from those slices alone and written as slices of their
own, one for each batch of the stream, so a repeated step writes them once.
Counts add up, so a closed window is corrected by adding its late rows: Bronze
is not counted again.

Spark keeps the offsets of the last hundred or so batches; :func:`keep_late_rows`
raises if it was not run for longer than that, rather than guess a watermark.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import all_present
from strata.operators.windows import window_counts
from strata.sources.ledger import RunLedger, State
from strata.streaming.batches import BATCH_COL, STREAM_COL, last_committed, query_id
from strata.streaming.windows import event_time

_NOTE = "late_rows_up_to"


def batch_log(spark: SparkSession, checkpoint: str) -> dict[int, tuple[int, int]]:
    """Watermark (ms since 1970) and last entry of the source log that each
    batch of the offset log was planned with."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/offsets").select("value", F.col("_metadata.file_name").alias("file"))
    batches = lines.groupBy(F.col("file").try_cast("bigint").alias("batch")).agg(
        F.max(F.get_json_object("value", "$.batchWatermarkMs").try_cast("bigint")).alias("mark"),
        F.max(F.get_json_object("value", "$.logOffset").try_cast("bigint")).alias("entry"),
    )
    rows = batches.where(all_present("batch", "mark", "entry")).collect()  # a row for each batch that the log keeps
    return {r["batch"]: (r["mark"], r["entry"]) for r in rows}


def slices_read(spark: SparkSession, checkpoint: str, after: int) -> list[tuple[int, str, int]]:
    """(entry, stream, slice) of each slice in entries of the source log beyond ``after``."""
    log = spark.read.text(f"{checkpoint.rstrip('/')}/sources/0").where(F.col("value").startswith("{"))
    path = F.get_json_object("value", "$.path")
    slices = log.select(
        F.get_json_object("value", "$.batchId").cast("bigint").alias("entry"),
        F.regexp_extract(path, f"/{STREAM_COL}=([^/]+)/", 1).alias("stream"),
        F.regexp_extract(path, f"/{BATCH_COL}=([0-9]+)/", 1).try_cast("bigint").alias("slice"),
    )
    rows = slices.where((F.col("entry") > after) & F.col("slice").isNotNull()).distinct().collect()  # a row for each slice
    return sorted((r["entry"], r["stream"], r["slice"]) for r in rows)


def keep_late_rows(
    bronze: DataFrame,
    checkpoint: str,
    late_path: str,
    ledger_path: str,
    ts_col: str,
    size: str,
    required: Sequence[str] = (),
) -> list[int]:
    """Write the rows that the windowed stream of ``checkpoint`` dropped, for
    each batch it has committed since the last call; returns the batches that
    read slices.

    ``bronze`` are the slices that the stream reads, with ``_stream`` and
    ``_batch``; ``required`` the columns without which it left a row out."""
    spark = bronze.sparkSession
    ledger = RunLedger(spark, ledger_path)
    owner, last = query_id(spark, checkpoint), last_committed(spark, checkpoint)
    # a checkpoint started afresh counts its batches from 0 again
    done = ledger.last()[1].notes.get(_NOTE, {}).get(owner, -1)
    if last <= done:
        return []
    log = batch_log(spark, checkpoint)
    news = range(max(done + 1, 1), last + 1)  # nothing is closed before the first batch
    missing = [n for n in {*news, *(n - 1 for n in news)} if n not in log]
    if missing:
        raise ValueError(f"the offset log of {checkpoint} no longer holds batches {sorted(missing)}")
    slices = slices_read(spark, checkpoint, log[news[0] - 1][1]) if news else []
    rows = event_time(bronze, ts_col).where(all_present(ts_col, *required))
    kept = []
    for n in news:
        mark, before, upto = log[n - 1][0], log[n - 1][1], log[n][1]  # rows are late by the watermark of the batch before
        streams: dict[str, list[int]] = {}
        for entry, stream, number in slices:
            if before < entry <= upto:
                streams.setdefault(stream, []).append(number)
        if not streams:
            continue
        of_batch = F.lit(False)
        for stream, numbers in streams.items():
            of_batch = of_batch | ((F.col(STREAM_COL) == stream) & F.col(BATCH_COL).isin(numbers))
        late = rows.where(of_batch).withColumn("_closed_at", F.window(ts_col, size)["end"])
        late = late.where(F.col("_closed_at") <= F.timestamp_millis(F.lit(mark)))
        late.drop("_closed_at", STREAM_COL, BATCH_COL).write.mode("overwrite").parquet(
            f"{late_path.rstrip('/')}/{STREAM_COL}={owner}/{BATCH_COL}={n}"
        )
        kept.append(n)

    def change(state: State) -> None:
        upto = state.notes.setdefault(_NOTE, {})
        upto[owner] = max(last, upto.get(owner, -1))

    ledger.commit(change)
    return kept


def corrected_windows(gold: DataFrame, late: DataFrame, ts_col: str, keys: Sequence[str], size: str, count_alias: str = "event_count") -> DataFrame:
    """Gold windows with the late rows counted in; a window that only late rows
    have is added. ``late`` is aggregated before it meets Gold."""
    added = window_counts(event_time(late, ts_col), ts_col, keys, size, count_alias)
    window = ["window_start", "window_end", *keys]
    both = gold.select(*window, count_alias).unionByName(added)
    return both.groupBy(*window).agg(F.sum(count_alias).cast("bigint").alias(count_alias))
