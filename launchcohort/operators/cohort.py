"""From cumulative snapshots to one clean row per campaign."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from launchcohort.functions import scalars as S
from launchcohort.operators.ranking import quantiles

# The clean table, and what is only known after launch.
CLEAN_COLUMNS = [
    "id", "name", "blurb", "goal_usd", "usd_rate", "currency", "country", "category",
    "parent_category", "location", "location_type", "launched_at", "deadline", "y",
]
BANNED_COLUMNS = ["backers_count", "pledged", "usd_pledged", "staff_pick", "spotlight", "state"]
SNAPSHOT_ORDER = ["snapshot", "chunk", "row_no"]
# The two numbers lead, so that sorting seldom has to compare texts.
DEDUPE_KEY = ["launched_at", "deadline", "name", "blurb"]
# The same with a digest of the texts, so that texts travel only where they are asked for.
TEXTS = "_texts"
DIGEST_KEY = ["launched_at", "deadline", TEXTS]


def last_row(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row with the highest `order` for each key.

    Spark limits each group to one row per task before the shuffle, so a key that holds much of
    the data ships one row per task like any other.
    """
    latest = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(latest)).filter("_rank = 1").drop("_rank")


def latest_per_id(raw: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Cumulative snapshots -> the newest row of each id, before any filter on its state."""
    return last_row(raw, ["id"], order or [c for c in SNAPSHOT_ORDER if c in raw.columns])


def finished(df: DataFrame) -> DataFrame:
    """Campaigns with a final state, with the label `y`."""
    return df.filter(F.col("state").isin(list(S.FINAL_STATES))).withColumn("y", S.label(F.col("state")))


def normalised(df: DataFrame) -> DataFrame:
    """JSON fields, numbers, currency and text defaults."""
    rate = F.coalesce(S.to_number(F.col("static_usd_rate")), F.lit(1.0))
    columns = {
        "id": F.coalesce(F.col("id").try_cast("bigint"), S.to_whole(F.col("id"))),
        "parent_category": S.parent_of_slug(S.json_field(F.col("category"), "slug")),
        "category": S.json_field(F.col("category"), "name"),
        "location_type": S.json_field(F.col("location"), "type"),
        "location": S.json_field(F.col("location"), "name"),
        "usd_rate": rate,
        "goal_usd": S.to_number(F.col("goal")) * rate,
        "launched_at": S.to_whole(F.col("launched_at")),
        "deadline": S.to_whole(F.col("deadline")),
        "blurb": F.coalesce(F.col("blurb"), F.lit("")),
        "name": F.coalesce(F.col("name"), F.lit("")),
        "country": F.coalesce(F.col("country"), F.lit(S.UNKNOWN)),
        "currency": F.coalesce(F.col("currency"), F.lit(S.UNKNOWN)),
    }
    return df.withColumns(columns)


def complete(df: DataFrame) -> DataFrame:
    """Rows with goal, launch and deadline."""
    return df.dropna(subset=["goal_usd", "launched_at", "deadline"])


def is_valid():
    return (F.col("goal_usd") > 0) & (F.col("deadline") > F.col("launched_at"))


def in_window(launch_from: int | None = None, launch_to: int | None = None):
    """Launch in [from, to); either bound may be open."""
    inside = F.lit(True)
    if launch_from is not None:
        inside = inside & (F.col("launched_at") >= launch_from)
    if launch_to is not None:
        inside = inside & (F.col("launched_at") < launch_to)
    return inside


def with_texts_digest(raw: DataFrame) -> DataFrame:
    """Adds half a SHA-256 digest, 128 bits, of name and blurb, missing ones empty."""
    name, blurb = (F.coalesce(F.col(c), F.lit("")) for c in ("name", "blurb"))
    return raw.withColumn(TEXTS, F.unhex(F.substring(F.sha2(F.concat(F.length(name).cast("string"), F.lit(":"), name, blurb), 256), 1, 32)))


def without_repeats(df: DataFrame) -> DataFrame:
    """The last row, in the order of the files and then by id, of campaigns equal in name, blurb, launch and deadline."""
    return last_row(df, DIGEST_KEY if TEXTS in df.columns else DEDUPE_KEY, [c for c in SNAPSHOT_ORDER if c in df.columns] + ["id"])


def without_banned(df: DataFrame) -> DataFrame:
    """Drop what is only known after launch."""
    return df.drop(*BANNED_COLUMNS)


def banned_in(df: DataFrame) -> list[str]:
    return [c for c in BANNED_COLUMNS if c in df.columns]


def clean(raw: DataFrame, launch_from: int | None = None, launch_to: int | None = None) -> DataFrame:
    """Raw snapshots -> clean table: two shuffles, one by id and one by the repeat key."""
    return (
        raw.transform(with_texts_digest).transform(latest_per_id).transform(finished).transform(normalised).transform(complete)
        .filter(is_valid()).filter(in_window(launch_from, launch_to))
        .transform(without_repeats).select(*CLEAN_COLUMNS)
    )


def funnel(raw: DataFrame, launch_from: int | None = None, launch_to: int | None = None) -> DataFrame:
    """Rows left after each cleaning step, as one row.

    The rows of one repeat key are counted together first, so one pass behind the newest-row
    shuffle gives every count, the number of keys included.
    """
    kept = is_valid() & in_window(launch_from, launch_to)
    final = F.col("state").isin(list(S.FINAL_STATES))
    flagged = (
        raw.transform(with_texts_digest).transform(latest_per_id).transform(normalised)
        .withColumn("final", F.coalesce(final, F.lit(False)).cast("bigint"))
        .withColumn("kept", F.coalesce(final & kept, F.lit(False)).cast("bigint"))
    )
    per_key = flagged.groupBy(*DIGEST_KEY).agg(
        F.count("*").alias("ids"), F.sum("final").alias("finals"), F.sum("kept").alias("kepts")
    )
    counts = per_key.agg(
        F.sum("ids").alias("n_unique_ids"),
        F.sum("finals").alias("n_finished"),
        F.sum("kepts").alias("n_after_window"),
        F.count_if(F.col("kepts") > 0).alias("n_final"),
    )
    read = raw.agg(F.count("*").alias("n")).scalar()
    return counts.select(
        read.alias("n_rows_read"), "n_unique_ids", "n_finished", "n_after_window",
        (F.col("n_after_window") - F.col("n_final")).alias("n_dropped_name_dupes"), "n_final",
    )


def profile(df: DataFrame, launch_from: int | None = None, launch_to: int | None = None) -> DataFrame:
    """One row that describes the clean cohort; the median is exact."""

    def bound(epoch: int | None):
        return F.lit("all") if epoch is None else S.launch_date(F.lit(epoch)).cast("string")

    median = quantiles(df, "goal_usd", {"goal_usd_median": 0.5}).scalar()
    return df.agg(
        F.avg("y").alias("success_rate"),
        S.launch_date(F.min("launched_at")).cast("string").alias("launch_min"),
        S.launch_date(F.max("launched_at")).cast("string").alias("launch_max"),
        F.count_distinct("category").alias("n_categories"),
        F.count_distinct("parent_category").alias("n_parent_categories"),
        F.count_distinct("country").alias("n_countries"),
    ).withColumns({
        "cohort_from": bound(launch_from), "cohort_to": bound(launch_to), "goal_usd_median": median,
    })
