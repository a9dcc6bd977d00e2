"""Landing zone: raw batches partitioned by arrival date.

Layout ``{root}/{source}/ingest_date={YYYY-MM-DD}/batch_id={id}/part-*.json``.
A batch is a directory, so landing the same batch id again replaces it. The
files are JSON lines (splittable); files that hold one JSON array or object
spread over lines are read and ingested with ``multi_line=True``, at the price
of one task per file. Ingest fails on a record that is no JSON, so such a file
read as JSON lines cannot leave line fragments in Bronze.
"""
from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.lineage import file_path_column, stamp_slice
from strata.session import path_exists
from strata.sources.tables import replace_slice, replace_table_slice, string_partition_values


def new_batch_id() -> str:
    """Unique among concurrent writers; sorts by the second it was made in."""
    return "_".join((time.strftime("%Y%m%d%H%M%S", time.gmtime()), uuid.uuid4().hex))


def today_utc() -> str:
    return f"{datetime.now(timezone.utc):%Y-%m-%d}"


def slice_path(root: str, source: str, ingest_date: str) -> str:
    return f"{root.rstrip('/')}/{source}/ingest_date={ingest_date}"


def batch_path(root: str, source: str, batch_id: str, ingest_date: str | None = None) -> str:
    """Where one batch lands: ``{root}/{source}/ingest_date={d}/batch_id={id}``."""
    return f"{slice_path(root, source, ingest_date or today_utc())}/batch_id={batch_id}"


def land_batch(
    df: DataFrame,
    root: str,
    source: str,
    ingest_date: str | None = None,
    batch_id: str | None = None,
) -> str:
    """Write one raw batch as JSON lines; returns its directory."""
    path = batch_path(root, source, batch_id or new_batch_id(), ingest_date)
    df.write.mode("overwrite").json(path)
    return path


def landed_batch(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of one landed batch, with the types they had."""
    return spark.read.schema(schema).json(path)


def read_landing(
    spark: SparkSession,
    root: str,
    source: str,
    ingest_date: str | None = None,
    schema: StructType | str | None = None,
    multi_line: bool = False,
    sampling_ratio: float = 1.0,
    fail_on_corrupt: bool = False,
) -> DataFrame:
    """All batches landed for one arrival date, with ``_source_file`` per row.

    A record that cannot be parsed is a row of NULLs, or with
    ``fail_on_corrupt`` an error; with a schema that goes for a value of
    another type too.

    Without a schema every field is read as a string, so a field that holds
    ``1`` in one batch and ``2.5`` in the next cannot change type between
    Bronze slices; Silver does the typing. A date with nothing landed is an
    empty batch, not an error. Without a schema the field names are found by
    an inference pass over the slice; ``sampling_ratio`` bounds how much of
    it that pass parses.
    """
    path = slice_path(root, source, ingest_date or today_utc())
    reader = spark.read.option("multiLine", str(multi_line).lower())
    if fail_on_corrupt:
        reader = reader.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("primitivesAsString", "true").option("samplingRatio", sampling_ratio)
    empty_schema = schema if schema is not None else "_corrupt_record string"
    empty = spark.createDataFrame([], empty_schema).withColumn("_source_file", F.lit(None).cast("string"))
    if not path_exists(spark, path):
        return empty
    try:
        with string_partition_values(spark):
            df = reader.json(path)
    except AnalysisException as err:
        if "UNABLE_TO_INFER_SCHEMA" not in str(err):  # only empty files were landed
            raise
        return empty
    return df.withColumn("_source_file", file_path_column())


def ingest_bronze(
    spark: SparkSession,
    landing_root: str,
    source: str,
    bronze_path: str,
    ingest_date: str | None = None,
    schema: StructType | str | None = None,
    sampling_ratio: float = 1.0,
    multi_line: bool = False,
) -> int:
    """Landing slice -> Bronze slice: stamp lineage (keeping each row's own
    file) and replace the ``_ingest_date`` slice. Returns rows written. Fails,
    and leaves the slice, on records that are no JSON."""
    d = ingest_date or today_utc()
    raw = read_landing(spark, landing_root, source, d, schema, multi_line, sampling_ratio, fail_on_corrupt=True)
    bronze = stamp_slice(raw, source, d)
    return replace_slice(bronze.drop("_ingest_date"), bronze_path, "_ingest_date", d)


def ingest_bronze_table(
    spark: SparkSession,
    landing_root: str,
    source: str,
    table: str,
    ingest_date: str | None = None,
    schema: StructType | str | None = None,
    sampling_ratio: float = 1.0,
    multi_line: bool = False,
) -> str:
    """Landing slice -> Bronze catalog table partitioned by ``_ingest_date``.

    The slice is written to a fresh folder and the partition repointed in
    one catalog operation (see ``replace_table_slice``): a rerun replaces the
    slice, readers never see it half-replaced, and fields that appear in a
    later batch are added to the table. Returns the slice's folder."""
    d = ingest_date or today_utc()
    raw = read_landing(spark, landing_root, source, d, schema, multi_line, sampling_ratio, fail_on_corrupt=True)
    bronze = stamp_slice(raw, source, d)
    return replace_table_slice(spark, bronze, table, "_ingest_date", d)
