"""Incremental file stream source with schema hints and a persisted schema.

The source discovers new JSON-lines files under a folder (Spark's file stream
source, checkpointed, exactly-once with a file or table sink). Its schema is
resolved once: inferred from the files already present, overridden and
completed by DDL hints, and merged with the schema persisted at
``schema_location`` by an earlier run, so a field once seen keeps its type and
position and a new field is appended.
"""
from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.lineage import file_path_column
from strata.session import path_exists


def _read_persisted(spark: SparkSession, schema_location: str) -> StructType | None:
    if not path_exists(spark, schema_location):
        return None
    rows = spark.read.text(schema_location).collect()  # one line: the schema JSON
    return StructType.fromJson(json.loads(rows[0][0])) if rows else None


def _persist(spark: SparkSession, schema: StructType, schema_location: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(schema_location)


def merge_schemas(base: StructType | None, incoming: StructType) -> StructType:
    """Fields of ``base`` keep their type and position; new fields append."""
    if base is None:
        return incoming
    known = {f.name for f in base.fields}
    return StructType([*base.fields, *[f for f in incoming.fields if f.name not in known]])


def apply_hints(inferred: StructType, hints_ddl: str | None) -> StructType:
    """Hinted fields take the hinted type; hinted fields not seen yet are added."""
    if not hints_ddl:
        return inferred
    hints = StructType.fromDDL(hints_ddl)
    by_name = {f.name: f for f in hints.fields}
    fields = [
        StructField(f.name, by_name[f.name].dataType, True) if f.name in by_name else f
        for f in inferred.fields
    ]
    seen = {f.name for f in fields}
    fields += [StructField(h.name, h.dataType, True) for h in hints.fields if h.name not in seen]
    return StructType(fields)


def resolve_schema(
    spark: SparkSession,
    source_path: str,
    hints_ddl: str | None = None,
    schema_location: str | None = None,
    sampling_ratio: float = 1.0,
    evolve: bool = False,
) -> StructType:
    """Schema for the stream: persisted + hints, and inferred fields.

    Inference (a batch read over the files present, ``samplingRatio`` bounds
    how many rows it parses) runs on the first run, when nothing is
    persisted yet, and on later runs only with ``evolve=True`` to pick up
    new fields; otherwise a rerun costs no scan of the backlog."""
    persisted = _read_persisted(spark, schema_location) if schema_location else None
    inferred = StructType([])
    if (persisted is None or evolve) and path_exists(spark, source_path):
        try:
            inferred = (
                spark.read.option("samplingRatio", sampling_ratio)
                .option("primitivesAsString", "false")
                .json(source_path)
                .schema
            )
            inferred = StructType([f for f in inferred.fields if f.name != "_corrupt_record"])
        except AnalysisException:  # a folder without readable records yet
            pass
    resolved = merge_schemas(persisted, apply_hints(inferred, hints_ddl))
    if not resolved.fields:
        raise ValueError(f"no schema: nothing to infer under {source_path} and no hints")
    if schema_location and resolved != persisted:
        _persist(spark, resolved, schema_location)
    return resolved


DEFAULT_MAX_FILES_PER_TRIGGER = 1000
#: Text of a line that is no JSON or has a value of another type than its field.
RESCUED_COL = "_rescued"


def read_json_stream(
    spark: SparkSession,
    source_path: str,
    schema: StructType,
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """New JSON-lines files as a stream, with ``_ingested_at`` (micro-batch
    time) and ``_source_file`` (each row's own file). A line that is no JSON,
    or has a value its field cannot take, is kept whole in ``_rescued``; the
    fields that could be read are filled.

    A drain over a large backlog is cut into micro-batches of at most
    ``max_files_per_trigger`` files (None: one batch), so no single batch
    has to hold the whole backlog."""
    if RESCUED_COL not in schema.fieldNames():
        schema = StructType([*schema.fields, StructField(RESCUED_COL, StringType(), True)])
    reader = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", RESCUED_COL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(source_path).withColumns(
        {"_ingested_at": F.current_timestamp(), "_source_file": file_path_column()}
    )


def read_events_stream(
    spark: SparkSession,
    source_path: str,
    schema_location: str,
    hints_ddl: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Hinted, inferred, persisted-schema JSON stream over ``source_path``. A
    backlog is one batch unless the caller bounds it: a watermark put straight
    on a bounded stream moves between its batches."""
    schema = resolve_schema(spark, source_path, hints_ddl, schema_location)
    return read_json_stream(spark, source_path, schema, max_files_per_trigger)
