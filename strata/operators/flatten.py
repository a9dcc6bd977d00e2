"""Columnar payload flattening: a struct of parallel arrays becomes one row per
element of the index array.

Semantics: the index array decides the row count; another array shorter than
it (or NULL / missing) yields NULL at the missing positions; extra trailing
values are ignored; a NULL index array yields no rows. ``arrays_zip`` alone
would pad to the longest array and invent rows, so the zip is cut to the index.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, NullType, StringType, StructType


def flatten_columnar(
    df: DataFrame,
    payload_col: str,
    index_field: str = "time",
    keep: Sequence[str] = (),
    index_alias: str | None = None,
    position_alias: str | None = None,
) -> DataFrame:
    """Explode ``payload_col.index_field`` with its position and pick the same
    position out of every other array field of the payload.

    ``payload_col`` must be a struct of arrays; the variables are all its array
    fields except the index. A ``map<string, array>`` payload goes through
    :func:`flatten_map_payload`, which takes the variable names explicitly.
    """
    dtype = df.schema[payload_col].dataType
    if isinstance(dtype, MapType):
        raise TypeError("map payloads: use flatten_map_payload with explicit variables")
    if not isinstance(dtype, StructType):
        raise TypeError(f"{payload_col} is {dtype.simpleString()}, expected a struct of arrays")
    arrays = {f.name for f in dtype.fields if isinstance(f.dataType, ArrayType)}
    # a field that was NULL in every document has no array type: it reads NULL
    untyped = {f.name for f in dtype.fields if f.name not in arrays and isinstance(f.dataType, (NullType, StringType))}
    variables = [f.name for f in dtype.fields if f.name != index_field and f.name in arrays | untyped]
    if index_field not in arrays:  # nothing to explode by
        index = F.lit(None).cast("array<string>")
    else:
        index = F.col(f"{payload_col}.{index_field}")
    field = {v: F.col(f"{payload_col}.{v}") if v in arrays else F.lit(None).cast("array<string>") for v in variables}
    out = _zipped(index, field, index_alias or index_field, position_alias)
    return df.select(*keep, out).select(*keep, index_alias or index_field, *([position_alias] if position_alias else []), *variables)


def _zipped(index: Column, field: dict[str, Column], index_name: str, position_name: str | None) -> Column:
    """Generates the rows. The arrays are zipped and cut to the index's length,
    so that a row carries its own values only and not the payload. A NULL array
    counts as empty, as a zip with it would be NULL."""
    position = [] if position_name is None else [F.sequence(F.lit(0), F.size(index) - 1)]
    parts = [index, *position, *[F.coalesce(c, F.array()) for c in field.values()]]
    names = [index_name, *([position_name] if position_name else []), *field]
    some = F.when(F.size(index) > 0, F.slice(F.arrays_zip(*parts), F.lit(1), F.size(index)))
    return F.inline(some).alias(*names)


def flatten_map_payload(
    df: DataFrame,
    payload_col: str,
    variables: Sequence[str],
    index_field: str = "time",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Same as :func:`flatten_columnar` for a ``map<string, array>`` payload."""
    field = {v: F.col(payload_col)[v] for v in variables}
    return df.select(*keep, _zipped(F.col(payload_col)[index_field], field, index_field, None))
