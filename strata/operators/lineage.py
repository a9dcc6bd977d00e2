"""Bronze lineage stamping: raw columns untouched, lineage columns appended."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINEAGE_COLUMNS = ("_ingested_at", "_source_system", "_batch_id", "_source_file")


def add_bronze_metadata(
    df: DataFrame,
    source_system: str,
    batch_id: str,
    source_file: str | None = None,
) -> DataFrame:
    """Append ``_ingested_at`` (one timestamp per query), ``_source_system``,
    ``_batch_id`` and ``_source_file``; a missing file stays a typed NULL.

    When ``df`` already carries a ``_source_file`` column (the per-file path
    from the scan) and no constant is given, that column is kept.
    """
    cols = {
        "_ingested_at": F.current_timestamp(),
        "_source_system": F.lit(source_system),
        "_batch_id": F.lit(batch_id),
    }
    if source_file is not None or "_source_file" not in df.columns:
        cols["_source_file"] = F.lit(source_file).cast("string")
    return df.withColumns(cols)


def stamp_slice(
    df: DataFrame,
    source_system: str,
    ingest_date: str,
    source_path: str | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Lineage for one arrival-date slice: ``_batch_id`` defaults to
    ``{source}-{date}`` and ``_ingest_date`` names the slice the row belongs to."""
    stamped = add_bronze_metadata(
        df,
        source_system=source_system,
        batch_id=batch_id or f"{source_system}-{ingest_date}",
        source_file=source_path,
    )
    return stamped.withColumn("_ingest_date", F.lit(ingest_date))


def file_path_column() -> F.Column:
    """Per-row source file from the scan's hidden metadata (batch and stream)."""
    return F.col("_metadata.file_path")
