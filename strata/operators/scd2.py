"""Type 2 slowly changing dimension as a pure DataFrame function.

Without a MERGE-capable table format the new version of the dimension is
computed as a DataFrame and published as a whole (see
``strata.sources.versions.publish_version``). One full outer join between the
open rows and the updates decides every case:

* key open and attributes equal (NULL-safe)   -> open row kept
* key open and attributes differ              -> old row closed at the update's
                                                 ``effective_from`` + new open row
* key not open (new, or only closed versions) -> update inserted open
* key open but absent from the updates        -> open row kept (no deletes)
* NULL key in the updates                     -> never matches, always inserted
Closed history rows and rows with a NULL key, of either side, are carried over
without entering the join: NULL keys never match, and an outer join would put
all of them into one task. A dimension stored by ``is_current`` is read once,
as the two filters on it read different folders.

Both sides of the join have at most one row per key (open rows by
construction, updates by the uniqueness check), so it cannot fan out or skew
on a hot key.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import all_present, differs_null_safe
from strata.operators.quality import assert_unique


def scd2_initial(
    updates: DataFrame,
    from_col: str = "effective_from",
    to_col: str = "effective_to",
    current_col: str = "is_current",
) -> DataFrame:
    """First load: every update becomes an open version; ``to_col`` takes
    the type of ``from_col``."""
    from_type = dict(updates.dtypes)[from_col]
    return updates.withColumns(
        {to_col: F.lit(None).cast(from_type), current_col: F.lit(True)}
    )


def scd2_merge(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    from_col: str = "effective_from",
    to_col: str = "effective_to",
    current_col: str = "is_current",
    check_unique_updates: bool = True,
) -> DataFrame:
    """The next full version of ``target`` after applying ``updates``.

    ``updates`` has ``keys + tracked + [from_col]``; ``target`` additionally
    has ``to_col`` and ``current_col``. Several updates for one key are
    rejected (a MERGE would fail the same way).
    """
    if check_unique_updates:
        assert_unique(updates.filter(all_present(*keys)), keys)

    dim_cols = [*keys, *tracked, from_col]
    out_cols = [*dim_cols, to_col, current_col]
    from_type = dict(target.dtypes)[to_col]

    keyed = all_present(*keys)
    joins = F.coalesce(F.col(current_col), F.lit(False)) & keyed
    carried = target.filter(~joins).select(*out_cols)
    unkeyed = scd2_initial(updates.filter(~keyed).select(*dim_cols), from_col, to_col, current_col)
    unkeyed = unkeyed.withColumn(to_col, F.col(to_col).cast(from_type))

    t = target.filter(joins).select(*[F.col(c).alias(f"t_{c}") for c in dim_cols], F.lit(True).alias("t_"))
    s = updates.filter(keyed).select(*[F.col(c).alias(f"s_{c}") for c in dim_cols], F.lit(True).alias("s_"))
    cond = None
    for k in keys:
        eq = F.col(f"t_{k}") == F.col(f"s_{k}")
        cond = eq if cond is None else cond & eq
    joined = t.join(s, cond, "full_outer")

    has_t = F.col("t_").isNotNull()
    has_s = F.col("s_").isNotNull()
    changed = has_t & has_s & differs_null_safe(
        [F.col(f"t_{c}") for c in tracked], [F.col(f"s_{c}") for c in tracked]
    )

    old_row = F.when(
        has_t,
        F.struct(
            *[F.col(f"t_{c}").alias(c) for c in dim_cols],
            F.when(changed, F.col(f"s_{from_col}")).cast(from_type).alias(to_col),
            (~changed).alias(current_col),
        ),
    )
    new_row = F.when(
        has_s & (~has_t | changed),
        F.struct(
            *[F.col(f"s_{c}").alias(c) for c in dim_cols],
            F.lit(None).cast(from_type).alias(to_col),
            F.lit(True).alias(current_col),
        ),
    )
    expanded = (
        joined.select(F.explode(F.array(old_row, new_row)).alias("r"))
        .filter(F.col("r").isNotNull())
        .select("r.*")
    )
    return carried.unionByName(expanded).unionByName(unkeyed)
