"""Incremental reads: high-water marks, cursor and date-window reads, paging.

The high-water-mark store is an append-only control table keyed by source:
``set`` appends one row, ``get`` returns the newest row for the source. An
append is one file commit, so a crashed run never leaves a half-written
store, and the history of marks stays inspectable.
"""
from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.session import path_exists

HWM_SCHEMA = "source string, value string, updated_at timestamp_ntz, seq bigint"


class HighWaterMarks:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _table(self) -> DataFrame | None:
        if not path_exists(self.spark, self.path):
            return None
        return self.spark.read.schema(HWM_SCHEMA).parquet(self.path)

    def get(self, source: str, default: str) -> str:
        table = self._table()
        if table is None:
            return default
        rows = (
            table.filter(F.col("source") == source)
            .orderBy(F.col("seq").desc())
            .limit(1)  # the newest mark is the feature
            .collect()
        )
        return rows[0]["value"] if rows else default

    def set(self, source: str, value: str) -> None:
        row = [(source, value, datetime.now(timezone.utc).replace(tzinfo=None), time.time_ns())]
        self.spark.createDataFrame(row, HWM_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def current(self) -> DataFrame:
        """Newest mark per source, as a DataFrame."""
        table = self._table()
        if table is None:
            return self.spark.createDataFrame([], HWM_SCHEMA)
        w = Window.partitionBy("source").orderBy(F.col("seq").desc())
        return table.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def read_since(df: DataFrame, cursor_col: str, hwm, inclusive: bool = False) -> DataFrame:
    """Rows whose cursor is after the mark (``>``; ``>=`` with ``inclusive``,
    which re-reads rows equal to the mark so a later dedupe absorbs them
    instead of silently missing late rows that share the mark's value).
    The predicate is a plain comparison, so it reaches the Parquet scan."""
    c = F.col(cursor_col)
    mark = F.lit(hwm).cast(dict(df.dtypes)[cursor_col])
    return df.filter(c >= mark if inclusive else c > mark)


def cursor_max(df: DataFrame, cursor_col: str, alias: str = "new_hwm") -> DataFrame:
    return df.agg(F.max(cursor_col).alias(alias))


def advance_cursor(df: DataFrame, cursor_col: str, current):
    """New mark = greatest cursor value received; unchanged when nothing
    arrived."""
    value = cursor_max(df, cursor_col).collect()[0][0]
    return current if value is None else value


def date_window(hwm: str | date, today: str | date, lag_days: int = 2) -> tuple[date, date] | None:
    """``[hwm, today - lag_days]`` inclusive, or None when it is empty."""
    start = date.fromisoformat(str(hwm)[:10])
    end = date.fromisoformat(str(today)[:10]) - timedelta(days=lag_days)
    return None if start > end else (start, end)


def read_date_window(df: DataFrame, date_col: str, start: date, end: date) -> DataFrame:
    c = F.col(date_col)
    if dict(df.dtypes)[date_col] != "date":
        c = F.to_date(c)
    return df.filter(c.between(F.lit(start), F.lit(end)))


def load_date_window(
    df: DataFrame, date_col: str, marks: HighWaterMarks, source: str, default: str,
    today: str | date, land: Callable[[DataFrame], object], lag_days: int = 2,
) -> tuple[date, date] | None:
    """Date-window incremental load. ``land`` writes the window's rows; only
    when it has returned does the mark move to end + 1, so a failed landing
    is loaded again by the next run. An empty window is skipped (None); a
    window without rows fails and leaves the mark."""
    window = date_window(marks.get(source, default), today, lag_days)
    if window is None:
        return None
    start, end = window
    rows = read_date_window(df, date_col, start, end)
    if rows.isEmpty():
        raise ValueError(f"no rows for {source} in [{start}, {end}]")
    land(rows)
    marks.set(source, (end + timedelta(days=1)).isoformat())
    return start, end


def _after(order_cols: Sequence[str], after: Sequence) -> Column:
    """Lexicographic ``(c1, c2, ...) > (v1, v2, ...)`` in the order of an
    ascending sort: NULL comes before every value."""
    terms = []
    for i, (c, v) in enumerate(zip(order_cols, after, strict=True)):
        same = [F.col(p).eqNullSafe(F.lit(pv)) for p, pv in zip(order_cols[:i], after[:i], strict=True)]
        beyond = F.col(c).isNotNull() if v is None else F.col(c) > F.lit(v)
        terms.append(reduce(lambda a, b: a & b, [*same, beyond]))
    return reduce(lambda a, b: a | b, terms)


def keyset_page(
    df: DataFrame, order_cols: Sequence[str], page_size: int, after: Sequence | None = None
) -> DataFrame:
    """One page in a stable order: the rows after the last key of the previous
    page. Each page is a pushed-down filter plus a top-n (every task keeps at
    most ``page_size`` rows), so reading page k costs no more than page 1,
    unlike an OFFSET that sorts away all earlier pages."""
    rows = df.filter(_after(order_cols, after)) if after else df
    return rows.orderBy(*order_cols).limit(page_size)


def assign_pages(
    df: DataFrame,
    order_cols: Sequence[str],
    page_size: int,
    num_partitions: int | None = None,
    ordinal_col: str = "row_ordinal",
    page_col: str = "page_no",
) -> DataFrame:
    """Number every row in ``order_cols`` order and cut the numbering into
    pages, without a single-partition window.

    Range-partition and sort within partitions, count rows per partition
    (one small row per partition), prefix-sum those counts, and add each
    partition's offset to the row's position inside its partition. The
    offsets table holds one row per partition, so its broadcast is bounded
    by the partition count. ``order_cols`` should end with a unique key so
    the order, and therefore the numbering, is total.

    The range bounds come from a random sample, so two evaluations of the
    range exchange may cut the data differently. The partitioned, positioned
    rows are therefore checkpointed to the shared checkpoint folder once and
    both the counts and the numbering read that one copy; a lost executor
    re-reads the checkpoint instead of re-sampling.
    """
    n = num_partitions or df.sparkSession.sparkContext.defaultParallelism
    ranged = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumns(
            {"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}
        )
        .checkpoint(eager=True)
    )
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_offset"),
    )
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    numbered = ranged.join(F.broadcast(offsets), "_pid").withColumn(
        ordinal_col, F.col("_offset") + local
    )
    return numbered.withColumn(page_col, F.floor(F.col(ordinal_col) / page_size)).drop(
        "_pid", "_mid", "_offset"
    )


#: Key ranges counted in one pass, keys sampled to choose their bounds, and the
#: rows of a range from which it is divided again before a page is sorted out of it.
KEY_RANGES, BOUND_SAMPLE, SORTED_ROWS = 128, 4096, 1 << 20


def _key(columns: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)])


class _KeyRanges:
    """Rows of ``df`` by where their key lies between bounds. A bound is a tuple
    of texts (None: NULL), which come back as the exact values by a cast. NULL
    comes before every value, as in an ascending sort."""

    def __init__(self, df: DataFrame, order_cols: Sequence[str]):
        types = dict(df.dtypes)
        binary = [c for c in order_cols if types[c] == "binary"]
        if binary:
            raise ValueError(f"columns {binary} are binary: order by their hex text")
        self.order_cols, self.types = list(order_cols), [types[c] for c in order_cols]
        self.row = _key([F.col(c) for c in order_cols])

    def values(self, bound: tuple) -> list[Column]:
        return [F.lit(v).cast("string").cast(t) for v, t in zip(bound, self.types, strict=True)]

    def bounds(self, rows: DataFrame) -> list[tuple]:
        """Bounds of about equal ranges, from a sample of bounded size. Which
        keys it draws changes how ranges are cut, and no result."""
        drawn = rows.select(*self.order_cols).orderBy(F.rand()).limit(BOUND_SAMPLE).orderBy(*self.order_cols)
        keys = [tuple(r) for r in drawn.select(*[F.col(c).cast("string") for c in self.order_cols]).collect()]
        step = max(1, len(keys) // KEY_RANGES)
        return list(dict.fromkeys(keys[step // 2 :: step]))

    def number(self, bounds: Sequence[tuple]) -> Column:
        """How many bounds are not above the row's key, by binary search."""
        keys = [_key(self.values(b)) for b in bounds]

        def between(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            mid = (low + high) // 2
            return F.when(self.row < keys[mid], between(low, mid)).otherwise(between(mid + 1, high))

        return between(0, len(bounds))

    def within(self, low: tuple | None, high: tuple | None) -> Column:
        """``low <= key < high``; the first column's part can reach the scan."""
        first, cond = F.col(self.order_cols[0]), F.lit(True)
        if low is not None:
            cond = cond & (self.row >= _key(self.values(low)))
            if low[0] is not None:
                cond = cond & (first >= self.values(low)[0])
        if high is not None:
            cond = cond & (self.row < _key(self.values(high)))
            cond = cond & (first.isNull() if high[0] is None else (first.isNull() | (first <= self.values(high)[0])))
        return cond


def page_by_number(
    df: DataFrame, order_cols: Sequence[str], page_size: int, page: int, sorted_rows: int = SORTED_ROWS
) -> DataFrame:
    """OFFSET-style page ``page`` (0-based) in ``order_cols`` order, with its
    rows' ``row_ordinal`` and ``page_no``. For walking through pages in
    sequence, ``keyset_page`` is cheaper; this answers "give me page k"
    directly.

    The page is located by exact row counts of key ranges, a partial aggregate
    of a few numbers a task, and the range that holds it is divided again until
    it has at most ``sorted_rows`` rows (or two pages). Only that range is
    sorted: nothing is shuffled, checkpointed or numbered whole. ``order_cols``
    should end with a unique key, so that the order is total and every range
    can be divided. A page beyond the last has no rows."""
    ranges = _KeyRanges(df, order_cols)
    start, low, high, before, size = page * page_size, None, None, 0, None
    while size is None or size > max(sorted_rows, 2 * page_size):
        rows = df.where(ranges.within(low, high))
        cuts = ranges.bounds(rows)
        counts = rows.groupBy(ranges.number(cuts).alias("n")).count().collect()  # a row for each range
        at, ends, total = before, [], {r["n"]: r["count"] for r in counts}
        for n in range(len(cuts) + 1):
            ends.append((at, at + total.get(n, 0)))
            at += total.get(n, 0)
        holding = [n for n, (a, b) in enumerate(ends) if a < min(start + page_size, at) and b > start]
        if not holding:
            return df.where(F.lit(False)).withColumns({"row_ordinal": F.lit(0).cast("bigint"), "page_no": F.lit(0).cast("bigint")})
        first, last = holding[0], holding[-1]
        edges = [low, *cuts, high]
        narrower = ends[last][1] - ends[first][0]
        low, high, before = edges[first], edges[last + 1], ends[first][0]
        if narrower == size:
            break  # equal keys: no bound divides them
        size = narrower
    found = df.where(ranges.within(low, high)).orderBy(*order_cols).offset(start - before).limit(page_size)
    ordinal = F.row_number().over(Window.orderBy(*order_cols)) + F.lit(start - 1).cast("bigint")  # of one page
    return found.withColumns({"row_ordinal": ordinal, "page_no": F.lit(page).cast("bigint")})
