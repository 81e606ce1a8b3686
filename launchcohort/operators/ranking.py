"""Ranks, running totals and exact quantiles that never sort everything in one task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from launchcohort.session import written

SMALL = 65536
RANGES = (256, 10000)
ROWS_PER_RANGE = 1_000_000


def running_totals(counts: DataFrame, order: str, total: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Running sum of `total` in `order` within `by`, as `upto` (this row included), and `total_all`.

    `counts` has one row per (by, order). It is cut into ranges of about equal size, more of them
    the more rows there are; each range is summed alone, and only the at most 10,000 range sums of
    a group are added up in one place.
    """
    ranges = min(max(RANGES[0], counts.count() // ROWS_PER_RANGE), RANGES[1])
    cuts = [i / ranges for i in range(1, ranges)]
    found = counts.select(F.percentile_approx(F.col(order).cast("double"), cuts, 20 * ranges)).first()[0] or []
    splits = [-float("inf"), *sorted(set(found)), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="_order", outputCol="_range").transform(
        counts.withColumn("_order", F.col(order).cast("double")))
    sums = ranged.groupBy(*by, "_range").agg(F.sum(total).alias("_sum"))
    group = Window.partitionBy(*(by or (F.lit(0),)))
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by, "_range",
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        F.sum("_sum").over(group).alias("total_all"),
    )
    inside = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_inside", F.sum(total).over(inside))
        .join(offsets, [*by, "_range"])
        .withColumn("upto", F.col("_before") + F.col("_inside"))
        .drop("_order", "_range", "_inside", "_before")
    )


def value_positions(df: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Each distinct value with its row count `n`, the rows up to it, and all rows of the group."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    return running_totals(written(counts, "value-counts"), value, "n", by)


def at_share(value: str, share: Column | float) -> Column:
    """Aggregate over `value_positions`: the linearly interpolated quantile at `share`."""
    place = (F.col("total_all") - 1) * share
    low = F.min(F.when(F.col("upto") > F.floor(place), F.col(value)))
    high = F.min(F.when(F.col("upto") > F.ceil(place), F.col(value)))
    part = F.max(place - F.floor(place))
    return low + (high - low) * part


def quantiles(df: DataFrame, value: str, shares: dict[str, float], by: tuple[str, ...] = ()) -> DataFrame:
    """Exact quantiles of `value`, one column per name in `shares`."""
    placed = value_positions(df, value, by)
    return placed.groupBy(*by).agg(*[at_share(value, s).alias(name) for name, s in shares.items()])


def digits(key: Column) -> list[Column]:
    """A 64-bit key as four digits of at most 65,536 values, in sort order."""
    return [F.shiftright(key, 48)] + [F.shiftright(key, b).bitwiseAND(F.lit(65535)) for b in (32, 16)] + [
        key.bitwiseAND(F.lit(65535))]


def key_at_rank(df: DataFrame, rank: int, levels: list[Column]) -> list[int] | None:
    """The `rank`-th smallest (from 1) tuple of `levels`; each level has a bounded number of values.

    Counts the first level, steps into the value that holds the rank, and goes on with the next
    level there. When few rows are left they are sorted directly. Only bounded counts reach the driver.
    """
    if rank < 1:
        return None
    names = [f"_l{i}" for i in range(len(levels))]
    rest = df.select(*[c.cast("bigint").alias(n) for c, n in zip(levels, names)])
    found: list[int] = []
    for i, name in enumerate(names):
        counts = rest.groupBy(name).agg(F.count("*").alias("n")).toPandas().sort_values(name)
        upto = counts["n"].cumsum()
        if not len(counts) or rank > int(upto.iloc[-1]):
            return None
        spot = int((upto >= rank).to_numpy().argmax())
        rank -= int(upto.iloc[spot - 1]) if spot else 0
        found.append(int(counts[name].iloc[spot]))
        rest = rest.filter(F.col(name) == found[-1])
        if i + 1 < len(names) and counts["n"].iloc[spot] <= SMALL:
            row = rest.orderBy(*names[i + 1:]).limit(rank).toPandas().iloc[-1]
            return [int(row[n]) for n in names]
    return found


def up_to(levels: list[Column], bound: list[int] | None) -> Column:
    """True for rows whose tuple of `levels` is at most `bound`."""
    if bound is None:
        return F.lit(False)
    here = F.struct(*[c.cast("bigint") for c in levels])
    return here <= F.struct(*[F.lit(v).cast("bigint") for v in bound])
