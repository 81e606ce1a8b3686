"""What-if rows: any number of planned campaigns, scored like test rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from launchcohort.functions.scalars import DAY, UNKNOWN, strip
from launchcohort.operators.lookup import lookup

# The goals tried for each scenario, as multiples of its own.
MULTIPLIERS = [0.1, 0.25, 0.5, 1.0, 2.0, 4.0, 10.0]


def noon(day: Column) -> Column:
    """Epoch seconds of noon UTC on a date."""
    return F.unix_date(F.to_date(day)).cast("bigint") * DAY + DAY // 2


def with_known_values(scenarios: DataFrame, cat_parent: DataFrame, currency_rate: DataFrame) -> DataFrame:
    """Looks up the parent of the category and the currency's USD rate (1.0 when not known)."""
    parented = lookup(scenarios, cat_parent.select("category", F.col("parent_category").alias("_parent")), "category")
    rated = lookup(parented, currency_rate.select("currency", F.col("usd_rate").alias("_rate")), "currency")
    return rated.withColumns({
        "parent_category": F.coalesce("_parent", F.lit(UNKNOWN)), "usd_rate": F.coalesce("_rate", F.lit(1.0)),
    }).drop("_parent", "_rate")


def cohort_rows(scenarios: DataFrame, cat_parent: DataFrame, currency_rate: DataFrame) -> DataFrame:
    """Scenario rows (id, name, blurb, category, country, currency, goal, launch, days, location,
    location_type) in the shape of the clean table."""
    place = strip(F.coalesce("location", F.lit("")))
    return with_known_values(scenarios, cat_parent, currency_rate).select(
        "id", "name", "blurb", (F.col("goal") * F.col("usd_rate")).alias("goal_usd"), "usd_rate", "currency",
        "country", "category", "parent_category",
        F.when(place == "", UNKNOWN).otherwise(place).alias("location"), "location_type",
        noon(F.col("launch")).alias("launched_at"),
        (noon(F.col("launch")) + F.col("days").cast("bigint") * DAY).alias("deadline"),
    )


def base_id(rung_id: Column, multipliers: list[float] = MULTIPLIERS) -> Column:
    """The `id` of the row that a ladder's row was made of."""
    n = len(multipliers)
    return F.call_function("div", rung_id - F.pmod(rung_id, F.lit(n)), F.lit(n))


def ladder(rows: DataFrame, multipliers: list[float] = MULTIPLIERS) -> DataFrame:
    """Each row once per multiplier, with the goal multiplied: `base_id`, `rung` and a new `id`."""
    n = len(multipliers)
    steps = F.posexplode(F.array(*[F.lit(float(m)) for m in multipliers])).alias("rung", "multiplier")
    return rows.select("*", steps).withColumns({
        "base_id": F.col("id"), "id": F.col("id") * n + F.col("rung"),
        "goal_usd": F.col("goal_usd") * F.col("multiplier"),
    })
