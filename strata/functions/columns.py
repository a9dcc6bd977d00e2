"""Column expressions used by the Silver layer.

All of them are plain Catalyst expressions, so they stay inside whole-stage
codegen and push down where the optimizer can push them. Typing is lenient:
malformed input becomes NULL instead of failing the job, which is what the
ANSI-mode ``try_*`` family gives on Spark 4.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_timestamp(c: ColumnOrName, fmt: str | None = None) -> Column:
    """String to timestamp; unparseable text becomes NULL."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))


def lenient_cast(c: ColumnOrName, data_type: str) -> Column:
    """Cast that yields NULL on malformed input (``'abc'`` as double, ``'2'`` as boolean)."""
    return _col(c).try_cast(data_type)


def normalise_key(c: ColumnOrName) -> Column:
    """Upper-case and strip surrounding spaces (``trim`` strips spaces only)."""
    return F.upper(F.trim(_col(c)))


def null_outside(c: ColumnOrName, lo: float, hi: float) -> Column:
    """Keep a value inside the inclusive bounds, else NULL (NaN is outside)."""
    col = _col(c)
    return F.when(col.between(lo, hi), col)


def event_date(c: ColumnOrName) -> Column:
    return F.to_date(_col(c))


def any_null(*cols: ColumnOrName) -> Column:
    """TRUE when any of the columns is NULL; never NULL itself."""
    return reduce(lambda a, b: a | b, [_col(c).isNull() for c in cols])


def all_present(*cols: ColumnOrName) -> Column:
    return reduce(lambda a, b: a & b, [_col(c).isNotNull() for c in cols])


def differs_null_safe(left: list[Column], right: list[Column]) -> Column:
    """TRUE when any pair differs, treating two NULLs as equal."""
    return reduce(lambda a, b: a | b, [~l.eqNullSafe(r) for l, r in zip(left, right)])


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)
