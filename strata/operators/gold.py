"""Gold aggregates: rounded daily summaries, conditional-count rates and the
cross-domain rollup mart.

All are single ``groupBy().agg()`` hash aggregates, so Spark runs a partial
aggregate on the map side and shuffles one row per group per task: a hot
group costs one row per input split, not one row per record.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A double this close to a decimal, relatively, is that decimal (46.67 computed as 46.67000000000001).
NOISE = 1e-9

_AGGS = {
    "min": F.min,
    "max": F.max,
    "avg": F.avg,
    "sum": F.sum,
}


def daily_summary(
    df: DataFrame,
    group_cols: Sequence[str],
    measures: Mapping[str, tuple[str, str]],
    count_alias: str | None = None,
    digits: int = 2,
    exact_scale: int | None = None,
    inexact_alias: str | None = None,
) -> DataFrame:
    """``measures`` maps output name -> (aggregate, input column); every
    aggregate is rounded (HALF_UP) to ``digits``. ``count_alias`` adds
    ``count(*)``, which counts rows whose measured values are NULL too.

    With ``exact_scale`` sums and means are taken over decimals of that scale,
    so they are exact and the rounding happens on the true value. A double sum
    depends on the order rows arrive in, which changes with the partitioning;
    near a rounding boundary (a mean of ``x.xx5``) the rounded double result
    can then flip between runs. A group with a value that such a decimal does
    not hold but for the noise of a double (more digits, out of range, NaN,
    Infinity) has the plain double result instead, so nothing is rounded before
    the sum, lost or an error; ``inexact_alias`` adds the number of such values.
    """
    inexact: dict[str, Column] = {}

    def measure(fn: str, col: str) -> Column:
        c = F.col(col)
        plain = F.round(_AGGS[fn](c), digits)
        if exact_scale is None or fn in ("min", "max"):  # no sum: nothing depends on the order
            return plain
        dec = c.try_cast(f"decimal(18,{exact_scale})")
        apart = F.abs(dec.cast("double") - c.cast("double"))
        inexact[col] = c.isNotNull() & ~F.coalesce(apart <= NOISE * F.greatest(F.abs(c.cast("double")), F.lit(1.0)), F.lit(False))
        # the mean as sum / count: a decimal avg() already rounds at scale + 4,
        # and rounding twice could cross the boundary of the final rounding
        exact = F.sum(dec) / F.count(dec) if fn == "avg" else _AGGS[fn](dec)
        return F.when(F.bool_or(inexact[col]), plain.cast("double")).otherwise(F.round(exact, digits).cast("double"))

    aggs: list[Column] = [measure(fn, col).alias(name) for name, (fn, col) in measures.items()]
    if count_alias:
        aggs.append(F.count(F.lit(1)).alias(count_alias))
    if inexact_alias:
        counts = [F.count_if(c) for c in inexact.values()]
        aggs.append(reduce(lambda a, b: a + b, counts, F.lit(0).cast("bigint")).alias(inexact_alias))
    return df.groupBy(*group_cols).agg(*aggs)


def flag_rates(
    df: DataFrame,
    group_cols: Sequence[str],
    flags: Mapping[str, str | Column],
    count_alias: str,
    rate_of: tuple[str, str] | None = None,
    digits: int = 4,
) -> DataFrame:
    """Row count plus, per boolean flag, the number of TRUE rows.

    The flag sum is ``sum(cast(flag as int))``: NULL flags are skipped by the
    sum but stay in the row count, and a group whose flags are all NULL gets a
    NULL count and a NULL rate (``count_if`` would give 0 instead).
    ``rate_of = (flag_count_name, rate_name)`` adds
    ``round(flag_count / row_count, digits)``.
    """
    aggs = [F.count(F.lit(1)).alias(count_alias)]
    for name, flag in flags.items():
        col = F.col(flag) if isinstance(flag, str) else flag
        aggs.append(F.sum(col.cast("int")).cast("bigint").alias(name))
    out = df.groupBy(*group_cols).agg(*aggs)
    if rate_of:
        num, rate_name = rate_of
        out = out.withColumn(rate_name, F.round(F.col(num) / F.col(count_alias), digits))
    return out


def rollup_mart(
    facts: DataFrame,
    dims: DataFrame,
    fact_date: str,
    dim_date: str,
    dim_filter: Column,
    sum_cols: Mapping[str, str],
    attr_cols: Mapping[str, str],
    out_date: str | None = None,
) -> DataFrame:
    """Per date: sums of fact counts and the attributes of the one dimension
    row that matches ``dim_filter`` on that date (LEFT semantics: dates without
    a dimension row keep NULL attributes; NULL dates never match).

    Same result as ``facts LEFT JOIN dims ON dim_filter AND dates equal GROUP
    BY date`` with ``SUM`` / ``ANY_VALUE``, for any dimension (SUM distributes
    over the pre-aggregation, so a dimension with k rows on a date still
    multiplies that date's sum by k, as the join would). The facts are
    aggregated per date before the join, so the join and the final group see
    one fact row per date and the final group reuses the join's partitioning
    on the date. The filtered dimension is not hinted: AQE measures it at
    runtime and broadcasts it only under the broadcast threshold, otherwise
    the join stays a sort-merge join.
    """
    date_name = out_date or fact_date
    per_date = facts.groupBy(F.col(fact_date).alias(date_name)).agg(
        *[F.sum(F.col(src)).alias(f"_s_{name}") for name, src in sum_cols.items()]
    )
    right = dims.filter(dim_filter).select(
        F.col(dim_date).alias("_dim_date"),
        *[F.col(src).alias(f"_a_{name}") for name, src in attr_cols.items()],
    )
    joined = per_date.join(right, per_date[date_name] == right["_dim_date"], "left")
    return joined.groupBy(date_name).agg(
        *[F.sum(f"_s_{name}").alias(name) for name in sum_cols],
        *[F.any_value(f"_a_{name}").alias(name) for name in attr_cols],
    )
