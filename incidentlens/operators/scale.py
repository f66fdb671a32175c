"""Building blocks that keep joins and orderings spread over the cluster."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# A lookup of at most this many rows (a few narrow columns, so tens of MB) may
# be broadcast.  Larger ones are joined by a shuffle with hot keys set apart.
BROADCAST_ROWS = 500_000
# Beyond it, keys with more than this fraction (1/n) of the rows count as hot.
HOT_SHARE = 2_000
# Ordered work is cut into slices of about this many rows.
SLICE_ROWS = 500_000
MIN_SLICES, MAX_SLICES = 16, 1_024


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    weight: str,
    max_rows: int = BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Left join of detail rows to a lookup with unique keys (nulls match).

    `weight` names the lookup's column that holds how many detail rows have the
    key.  The lookup is written once and counted.  Within `max_rows` all of it is
    broadcast and the detail rows are not shuffled.  Beyond that only hot keys
    are: a key with more than 1/`hot_share` of the rows, of which there can be at
    most `hot_share`.  Rows of the other keys meet in a shuffle join, where no key
    is large; rows already served are spread evenly by a hash of the row."""
    lookup = materialize(lookup)
    if lookup.count() <= max_rows:
        return _null_safe_left(facts, F.broadcast(lookup), keys)
    values = [c for c in lookup.columns if c not in keys]
    total = lookup.agg(F.sum(weight)).first()[0]
    is_hot = F.col(weight) * hot_share > total
    hot = lookup.filter(is_hot).withColumn("_hot", F.lit(True))
    served = _null_safe_left(facts, F.broadcast(hot), keys)
    row_hash = F.xxhash64(*[F.col(c) for c in facts.columns])
    served = served.withColumn(
        "_spread", F.when(F.col("_hot"), row_hash).otherwise(F.lit(None).cast("bigint"))
    )
    cold = lookup.filter(~is_hot).withColumnsRenamed({c: f"_c_{c}" for c in values})
    cold = cold.withColumn("_spread", F.lit(None).cast("bigint"))
    joined = _null_safe_left(served, cold, [*keys, "_spread"])
    return joined.select(
        *facts.columns, *[F.coalesce(F.col(c), F.col(f"_c_{c}")).alias(c) for c in values]
    )


def _null_safe_left(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    return left.join(renamed, same, "left").drop(*[f"_r_{k}" for k in keys])


def block_join(
    probes: DataFrame, rows: DataFrame, keys: list[str], size: str, per_block: int = 50_000
) -> DataFrame:
    """Inner join of few probes per key to possibly very many rows per key.

    Both sides carry `size`, the number of rows of the key.  Rows of a key are
    cut into blocks of about `per_block` by a hash, and each probe is repeated
    once per block, so a hot key is as many tasks as its size asks for."""
    blocks = F.ceil(F.col(size) / per_block)
    cut = rows.withColumn("_block", F.pmod(F.xxhash64(*rows.columns), blocks)).drop(size)
    repeated = probes.withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))
    )
    return repeated.join(cut, [*keys, "_block"]).drop("_block")


def slices_for(rows: int) -> int:
    """Number of slices for ordered work on so many rows: a task sorts about
    `SLICE_ROWS` of them.  The cut points are an expression, so they are limited."""
    return min(MAX_SLICES, max(MIN_SLICES, -(-rows // SLICE_ROWS)))


def slice_by_value(df: DataFrame, value: str, slices: int | None = None) -> DataFrame:
    """Add `_slice`: the position of `value` among approximate quantiles of it.

    Slices follow the order of the values and hold about equally many rows, and
    the slice is a pure function of the value, so it is the same however often
    the plan is run.  Only the cut points reach the driver."""
    slices = slices or slices_for(df.count())
    wanted = [i / slices for i in range(1, slices)]
    cuts = sorted(set(df.agg(F.percentile_approx(value, wanted, 1000)).first()[0] or []))
    above = [(F.col(value) > F.lit(c)).cast("int") for c in cuts]
    return df.withColumn("_slice", reduce(lambda a, b: a + b, above, F.lit(0)))


def running_total(df: DataFrame, value: str, weight: Column, out: str = "through") -> DataFrame:
    """Sum of `weight` over all rows up to and including each one in the order
    of `value` (values must be distinct), without one global window.

    Rows are sliced by value; totals of the slices, one small row each, are
    accumulated and added to the running sum inside each slice."""
    sliced = slice_by_value(materialize(df.withColumn("_w", weight)), value)
    within = Window.partitionBy("_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.sum("_w").alias("_t"))
        .select("_slice", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
    )
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn(out, F.sum("_w").over(within) + F.col("_before"))
        .drop("_w", "_before", "_slice")
    )


def dense_numbers(df: DataFrame, value: str, tie: str, out: str) -> DataFrame:
    """Number rows 0, 1, 2, ... by `value`, without a global window.

    Rows of equal value are dealt by a hash of `tie` to as many parts as the number
    of rows asks for and numbered within those, so even if all values are equal
    no task gets all rows."""
    part = F.pmod(F.xxhash64(tie), F.lit(slices_for(df.count())))
    parted = df.withColumn("_part", part)
    counts = materialize(parted.groupBy(value, "_part").agg(F.count("*").alias("_n")))
    earlier = Window.partitionBy(value).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per_value = running_total(
        counts.groupBy(value).agg(F.sum("_n").alias("_n")), value, F.col("_n")
    ).select(value, (F.col("through") - F.col("_n")).alias("_before"))
    offsets = (
        counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(per_value, value)
        .select(value, "_part", (F.col("_before") + F.col("_ahead")).alias("_from"))
    )
    within = Window.partitionBy(value, "_part").orderBy(tie)
    return (
        parted.withColumn("_k", F.row_number().over(within))
        .join(offsets, [value, "_part"])
        .withColumn(out, (F.col("_from") + F.col("_k") - 1).cast("int"))
        .drop("_part", "_k", "_from")
    )


def with_neighbours(df: DataFrame, value: str, prev: str, next_: str) -> DataFrame:
    """The next smaller and next larger of distinct values, by slices."""
    sliced = slice_by_value(materialize(df), value)
    inside = Window.partitionBy("_slice").orderBy(value)
    across = Window.orderBy("_slice")
    ends = (
        sliced.groupBy("_slice")
        .agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
        .select(
            "_slice",
            F.lag("_hi").over(across).alias("_prev_hi"),
            F.lead("_lo").over(across).alias("_next_lo"),
        )
    )
    return (
        sliced.withColumns(
            {"_p": F.lag(value).over(inside), "_n": F.lead(value).over(inside)}
        )
        .join(F.broadcast(ends), "_slice")
        .withColumns(
            {
                prev: F.coalesce("_p", "_prev_hi"),
                next_: F.coalesce("_n", "_next_lo"),
            }
        )
        .drop("_slice", "_p", "_n", "_prev_hi", "_next_lo")
    )


def exact_median(df: DataFrame, value: str, max_values: int = 100_000) -> float | None:
    """Median of a column from its distinct values and their counts.

    Few distinct values are finished by one weighted percentile; beyond
    `max_values` the counts are accumulated slice by slice."""
    counted = materialize(
        df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    )
    if counted.count() <= max_values:
        return counted.agg(F.percentile(F.col(value).cast("double"), 0.5, F.col("n"))).first()[0]
    ranked = materialize(running_total(counted, value, F.col("n")))
    total = ranked.agg(F.max("through")).first()[0]
    # the rows at 1-based positions (total+1)/2 and total/2+1, equal if it is odd
    at = lambda position: F.min(F.when(F.col("through") >= position, F.col(value)))
    low, high = ranked.agg(at((total + 1) // 2), at(total // 2 + 1)).first()
    return (float(low) + float(high)) / 2
