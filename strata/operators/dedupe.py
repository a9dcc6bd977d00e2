"""Latest-row-per-key deduplication.

``row_number() = 1`` over the key lets Catalyst plan a partial
``WindowGroupLimit`` before the shuffle, so every map task ships at most one
row per key: a key holding a third of the table shrinks to one row per input
split before it reaches the reducer, and no task ever holds the whole group.

That limit reads its rows sorted, so a map task sorts, and spills, all it has.
Where keys have many rows each, :func:`combine_latest` goes before it: a task
keeps the latest row per key of what it has read so far and sorts those alone.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: A combining task drops the rows that another beats once it gathered this
#: many new ones (or as many as it kept), or this many bytes.
COMBINE_ROWS, COMBINE_BYTES = 1 << 18, 96 << 20
_SORTABLE = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _desc(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.desc_nulls_last()


def _latest(rows: pa.Table, keys: Sequence[str], order: Sequence[str]) -> pa.Table:
    """The first row per key by ``order``, descending and NULLs last."""
    group = np.zeros(rows.num_rows, np.int64)
    for k in keys:
        codes = rows.column(k).combine_chunks().dictionary_encode("encode").indices.to_numpy()
        group = np.unique(group * (codes.max() + 1) + codes, return_inverse=True)[1]
    by = {"group": pa.array(group)}
    for o in order:
        column = rows.column(o)
        if pa.types.is_floating(column.type):  # NaN is the greatest value
            by[f"nan {o}"] = pc.is_nan(column)
        if column.null_count or pc.min_max(column)["min"] != pc.min_max(column)["max"]:
            by[f"value {o}"] = column
    at = pc.sort_indices(pa.table(by), sort_keys=[(n, "ascending" if n == "group" else "descending") for n in by], null_placement="at_end")
    return rows.take(at.filter(pa.array(np.diff(group[at.to_numpy()], prepend=-1) != 0)))


def _combining(keys: Sequence[str], order: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kept, rows, size = [], 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                best.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= max(COMBINE_ROWS, kept) or size >= COMBINE_BYTES:
                latest = _latest(pa.Table.from_batches(best), keys, order)
                best, kept, rows, size = latest.to_batches(), latest.num_rows, 0, 0
                if latest.nbytes >= COMBINE_BYTES:  # too many keys to keep: they go on as they are
                    yield from latest.to_batches(10_000)
                    best, kept = [], 0
        if best:
            yield from _latest(pa.Table.from_batches(best), keys, order).to_batches(10_000)

    return run


def combine_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Drop rows of a task that another row of the task and the same key beats
    by ``order`` (descending, NULLs last; of equal ones the first row read
    stays). The latest row of every key stays, and rows beaten elsewhere only
    may, so a window has to follow. A task holds a bounded number of bytes: with
    more keys than that, it passes on what it has and starts again."""
    types = [df.schema[c].dataType for c in (*keys, *order)]
    if not all(isinstance(t, _SORTABLE) and getattr(t, "collation", "UTF8_BINARY") == "UTF8_BINARY" for t in types):
        return df
    return df.mapInArrow(_combining(list(keys), list(order)), df.schema)


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str | Column,
    tie_breakers: Sequence[str | Column] = (),
    repeated: bool = False,
) -> DataFrame:
    """Keep the row with the greatest ``order_col`` per key.

    NULL order values rank last; NULL keys form one group. Rows tying on
    ``order_col`` are resolved by ``tie_breakers`` (also descending); without
    them the survivor among ties is arbitrary. ``repeated`` says that keys have
    many rows each: tasks combine them before they sort (named columns only).
    """
    names = [order_col, *tie_breakers]
    if repeated and all(isinstance(c, str) for c in names):
        df = combine_latest(df, keys, names)
    order = [_desc(c) for c in names]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
