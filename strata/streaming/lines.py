"""Text-first event stream: lines are landed as text and parsed afterwards.

A stream that infers its schema before it reads loses a field that comes in
between. Here nothing is inferred. A line is parsed by the fields known so far,
and every other field of it is kept as text, under its name, in the map
``_extra``. After a pass, fields found there become known: later batches have
them as columns. :func:`read_lines` shows one column for such a field whether a
slice holds it in the map or as a column, so when it was taken up makes no
difference to a reader.

Known fields are kept in a ledger of create-if-absent commits, so two passes
that take up fields at a time both keep theirs. A field taken up is text (its
type cannot then clash with a later line) unless ``hints_ddl`` names a type.

Spark's reader writes a fraction taken as text by its double value (1.50 is
``1.5``); a field that needs more digits gets a decimal type by ``hints_ddl``.

Defined results: blank lines are left out; a line that is no JSON object, or
has a value that its field cannot take, is kept whole in ``_rescued`` beside
the fields that could be read; names that differ from a known one only by case,
blank names and names of the sink's own columns stay in ``_extra``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructField, StructType, TimestampType

from strata.functions.columns import all_present
from strata.operators.lineage import file_path_column
from strata.sources.ledger import RunLedger, State
from strata.streaming.batches import BATCH_COL, BATCH_FIELDS, STREAM_COL, batch_schema, last_committed, query_id, read_batches, run_batches
from strata.streaming.late import corrected_windows, keep_late_rows
from strata.streaming.sinks import RunStats, TwoHopPaths
from strata.streaming.sources import DEFAULT_MAX_FILES_PER_TRIGGER, RESCUED_COL
from strata.streaming.windows import watermarked_window_counts

EXTRA_COL = "_extra"
LINEAGE = [StructField("_ingested_at", TimestampType()), StructField("_source_file", StringType())]
_TAIL = [StructField(RESCUED_COL, StringType()), StructField(EXTRA_COL, MapType(StringType(), StringType())), *LINEAGE]
RESERVED = {f.name for f in [*_TAIL, *BATCH_FIELDS]}
#: Mark of a field that earlier slices hold in ``_extra``.
_TAKEN_UP = "taken_up"
_NOTE = "fields"


def taken_up(schema: StructType) -> list[StructField]:
    return [f for f in schema.fields if f.metadata.get(_TAKEN_UP)]


class KnownFields:
    """The fields of a stream, in the notes of a ledger at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.ledger = RunLedger(spark, path)

    @staticmethod
    def _of(state: State) -> StructType:
        return StructType.fromJson(state.notes[_NOTE]) if _NOTE in state.notes else StructType([])

    def schema(self) -> StructType:
        return self._of(self.ledger.last()[1])

    def add(self, fields: Sequence[StructField]) -> StructType:
        """Append the fields whose names are not known yet; known ones keep
        their type and place. Without a new one nothing is committed."""
        def fresh(schema: StructType) -> list[StructField]:
            names = {f.name.lower() for f in schema.fields} | RESERVED
            out = []
            for f in fields:
                if f.name.strip() and f.name.lower() not in names:
                    names.add(f.name.lower())
                    out.append(f)
            return out

        def change(state: State) -> None:
            known = self._of(state)
            state.notes[_NOTE] = StructType([*known.fields, *fresh(known)]).jsonValue()

        if fresh(self.schema()):
            self.ledger.commit(change)
        return self.schema()


def read_lines_stream(spark: SparkSession, source_path: str, max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER) -> DataFrame:
    """New text files as a stream of lines (``value``) with their lineage."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.text(source_path).withColumns({"_ingested_at": F.current_timestamp(), "_source_file": file_path_column()})
    return lines.where(F.trim("value") != "")


def parse_lines(lines: DataFrame, schema: StructType, text_col: str = "value") -> DataFrame:
    """The fields of ``schema``, ``_rescued``, ``_extra`` (NULL if nothing is
    left over), then the other columns of ``lines``."""
    fields = StructType([*schema.fields, _TAIL[0]])
    row = F.from_json(text_col, fields, {"columnNameOfCorruptRecord": RESCUED_COL})
    known = schema.fieldNames()
    every = F.from_json(text_col, MapType(StringType(), StringType()))
    rest = F.map_filter(every, lambda k, _: ~k.isin(known)) if known else every
    others = [c for c in lines.columns if c != text_col]
    parsed = lines.select(row.alias("_row"), rest.alias(EXTRA_COL), *others)
    return parsed.select(
        *[F.col("_row").getField(f.name).alias(f.name) for f in fields.fields],
        F.when(F.size(EXTRA_COL) > 0, F.col(EXTRA_COL)).alias(EXTRA_COL),
        *others,
    )


def bronze_fields(schema: StructType) -> StructType:
    return StructType([*schema.fields, *_TAIL])


def unified(bronze: DataFrame, schema: StructType) -> DataFrame:
    """Fields taken up come from their column or, in slices written before,
    from ``_extra``, which no longer shows them. Other columns stay as they are,
    so filters on them still reach the scan."""
    later = taken_up(schema)
    if not later:
        return bronze
    names = [f.name for f in later]

    def value(f: StructField) -> Column:
        text = F.try_element_at(EXTRA_COL, F.lit(f.name))
        nested = isinstance(f.dataType, (StructType, ArrayType, MapType))
        return F.coalesce(F.col(f.name), F.from_json(text, f.dataType) if nested else text.try_cast(f.dataType))

    left = F.map_filter(EXTRA_COL, lambda k, _: ~k.isin(names))
    return bronze.withColumns({**{f.name: value(f) for f in later}, EXTRA_COL: F.when(F.size(left) > 0, left)})


def read_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Bronze of a text-first stream, by the fields known now."""
    return unified(read_batches(spark, path, bronze_fields(schema)), schema)


def take_up_fields(
    bronze: DataFrame, known: KnownFields, hints_ddl: str | None = None, min_rows: int = 1, max_fields: int = 1000
) -> StructType:
    """Make the fields found in ``_extra`` known: those in at least ``min_rows``
    rows, the ``max_fields`` most frequent of them at a time. The others stay
    in ``_extra``, whole. Reads that one column; a line with thousands of
    generated names costs rows of the shuffle, not of the driver."""
    hinted = {f.name: f.dataType for f in StructType.fromDDL(hints_ddl).fields} if hints_ddl else {}
    names = (
        bronze.where(F.col(EXTRA_COL).isNotNull())
        .select(F.explode(F.array_distinct(F.map_keys(EXTRA_COL))).alias("name"))
        .groupBy("name").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_rows)
        .orderBy(F.desc("n"), "name").limit(max_fields)
    )
    found = sorted(r["name"] for r in names.collect())  # at most max_fields rows
    return known.add([StructField(n, hinted.get(n, StringType()), True, {_TAKEN_UP: True}) for n in found])


def lines_pass(
    spark: SparkSession,
    paths: TwoHopPaths,
    ts_col: str,
    keys: Sequence[str],
    required: Sequence[str],
    hints_ddl: str,
    size: str = "10 minutes",
    delay: str = "15 minutes",
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
    *,
    state_partitions: int,
    min_rows: int = 1,
    late_path: str | None = None,
) -> tuple[RunStats, RunStats]:
    """One scheduled pass: landing lines -> Bronze slices -> windowed Gold slices.

    Bronze holds every line, and every field of it; Gold gets the closed
    windows of rows that have the ``required`` fields. Both are folders of
    slices by batch, so a batch that ran twice counts once. Hop 2 starts after
    hop 1 has committed all its batches and never sees a slice being replaced.
    ``hints_ddl`` types the fields known from the start, the time and the keys
    of the windows among them. With ``late_path`` the rows that came after
    their window had closed are kept there, for :func:`gold_windows`.

    Fields are taken up last. If a pass dies before, those that no later line
    has stay in ``_extra``.
    """
    known = KnownFields(spark, paths.schema_location)
    schema = known.add(StructType.fromDDL(hints_ddl).fields)
    lines = read_lines_stream(spark, paths.landing, max_files_per_trigger)
    hop1_checkpoint = f"{paths.checkpoints}/bronze"
    before = last_committed(spark, hop1_checkpoint)
    hop1 = run_batches(parse_lines(lines, schema), hop1_checkpoint, paths.bronze)

    bronze = spark.readStream.schema(batch_schema(bronze_fields(schema))).parquet(paths.bronze)
    rows = unified(bronze, schema).where(all_present(*required))
    windows = watermarked_window_counts(rows, ts_col, keys, size, delay)
    hop2 = run_batches(windows, f"{paths.checkpoints}/gold", paths.gold, state_partitions=state_partitions)
    written = read_batches(spark, paths.bronze, bronze_fields(schema))
    if late_path:
        keep_late_rows(unified(written, schema), f"{paths.checkpoints}/gold", late_path, f"{paths.checkpoints}/late", ts_col, size, required)
    fresh = written.where((F.col(STREAM_COL) == query_id(spark, hop1_checkpoint)) & (F.col(BATCH_COL) > before))
    if hop1.batches:
        take_up_fields(fresh, known, hints_ddl, min_rows)
    return hop1, hop2


def gold_windows(spark: SparkSession, paths: TwoHopPaths, ts_col: str, keys: Sequence[str], hints_ddl: str, size: str = "10 minutes", late_path: str | None = None) -> DataFrame:
    """Closed windows of :func:`lines_pass`, corrected by the late rows if
    ``late_path`` names where they are kept."""
    schema = KnownFields(spark, paths.schema_location).add(StructType.fromDDL(hints_ddl).fields)
    types = {f.name: f.dataType for f in schema.fields}
    window = [StructField("window_start", TimestampType()), StructField("window_end", TimestampType())]
    gold = read_batches(spark, paths.gold, StructType([*window, *[StructField(k, types[k]) for k in keys], StructField("event_count", LongType())]))
    gold = gold.drop(STREAM_COL, BATCH_COL)
    return corrected_windows(gold, read_lines(spark, late_path, schema), ts_col, keys, size) if late_path else gold
