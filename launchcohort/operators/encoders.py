"""Smoothed level means, with and without the row's own fold, in one pass over the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from launchcohort.functions.scalars import log_goal
from launchcohort.operators.lookup import lookup
from launchcohort.operators.ranking import quantiles
from launchcohort.session import written

# The encoded columns, the smoothing and the number of folds.
CAT_COLS = ["currency", "country", "category", "parent_category", "location", "location_type"]
SMOOTHING = 20.0
FOLDS = 5
MIN_LEVEL_COUNT = 50


def smoothed(total: Column, count: Column, prior: Column, smoothing: float) -> Column:
    """Mean shrunk to `prior`; a level without rows gets the prior itself."""
    weight = count + F.lit(float(smoothing))
    return F.when(weight == 0, prior).otherwise((total + F.lit(float(smoothing)) * prior) / weight)


def level_means(df: DataFrame, level: str, value: str, smoothing: float = SMOOTHING) -> DataFrame:
    """(level, n, mean): the smoothed mean of `value` per level of one column."""
    prior = df.agg(F.avg(value).alias("prior")).scalar()
    sums = df.groupBy(F.col(level).alias("level")).agg(F.count(value).alias("n"), F.sum(value).alias("total"))
    return sums.select("level", "n", smoothed(F.col("total"), F.col("n"), prior, smoothing).alias("mean"))


def unpivoted(df: DataFrame, columns: list[str], keep: list[Column | str]) -> DataFrame:
    """One row per (row, column): `keep`, `column`, `level`."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in columns])
    return df.select(*keep, F.explode(pairs).alias("_p")).select("*", "_p.column", "_p.level").drop("_p")


def level_sums(df: DataFrame, columns: list[str] = CAT_COLS, folds: int = FOLDS) -> DataFrame:
    """Per (column, level): rows, labels and log goals in all, and rows and labels per fold.

    `df` has `fold`, `y` and `goal_usd`. All columns are summed in one pass; each task sums its
    rows per level before the only shuffle, which then carries levels and no rows.
    """
    rows = unpivoted(df.withColumn("log_goal", log_goal(F.col("goal_usd"))), columns, ["fold", "y", "log_goal"])
    in_fold = [F.col("fold") == f for f in range(folds)]
    return rows.groupBy("column", "level").agg(
        F.count("*").alias("n"), F.sum("y").alias("s"), F.sum("log_goal").alias("g"),
        *[F.count_if(here).alias(f"n{f}") for f, here in enumerate(in_fold)],
        *[F.coalesce(F.sum(F.when(here, F.col("y"))), F.lit(0)).alias(f"s{f}") for f, here in enumerate(in_fold)],
    )


@dataclass
class LevelValues:
    """Fitted encodings: one row per (column, level) plus the priors for levels not seen."""

    levels: DataFrame
    te_prior: float
    goal_prior: float
    oof_priors: list[float]
    columns: list[str]

    def encode(self, df: DataFrame, out_of_fold: bool = False) -> DataFrame:
        """Adds m_te_*, m_goalmean_* and m_goaldiff_* for every column.

        With `out_of_fold` the rows need `fold`, and m_te_* uses the labels of the other folds only.
        """
        goal = log_goal(F.col("goal_usd"))
        for c in self.columns:
            mine = self.levels.filter(F.col("column") == c).select(
                F.col("level").alias(c), F.col("n").alias("_n"), F.col("te").alias("_te"),
                F.col("goalmean").alias("_goalmean"), F.col("oof").alias("_oof"))
            df = lookup(df, mine, c, rows_of="_n")
            if out_of_fold:
                prior = F.element_at(F.array(*[F.lit(p) for p in self.oof_priors]), F.col("fold") + 1)
                te = F.coalesce(F.element_at("_oof", F.col("fold") + 1), prior)
            else:
                te = F.coalesce("_te", F.lit(self.te_prior))
            mean = F.coalesce("_goalmean", F.lit(self.goal_prior))
            df = df.withColumns({f"m_goalmean_{c}": mean, f"m_goaldiff_{c}": goal - mean, f"m_te_{c}": te})
            df = df.drop("_n", "_te", "_goalmean", "_oof")
        return df


def fit_levels(df: DataFrame, columns: list[str] = CAT_COLS, folds: int = FOLDS,
               smoothing: float = SMOOTHING) -> LevelValues:
    """Every encoding of every column from one pass.

    What the other folds hold is the total less the own fold, so no fold is fitted again. Labels
    are whole numbers, so the subtraction is exact.
    """
    sums = written(level_sums(df, columns, folds), "level-sums")
    # Each row has exactly one level in a column, so the levels of one column add up to all rows.
    all_rows = sums.filter(F.col("column") == columns[0]).agg(
        *[F.sum(c).alias(c) for c in ("n", "s", "g")],
        *[F.sum(f"{k}{f}").alias(f"{k}{f}") for k in "ns" for f in range(folds)],
    ).first()
    te_prior, goal_prior = all_rows["s"] / all_rows["n"], all_rows["g"] / all_rows["n"]
    others = [(all_rows["s"] - all_rows[f"s{f}"], all_rows["n"] - all_rows[f"n{f}"]) for f in range(folds)]
    oof_priors = [s / n if n else te_prior for s, n in others]
    n, s = F.col("n"), F.col("s")
    levels = sums.select(
        "column", "level", "n",
        smoothed(s, n, F.lit(te_prior), smoothing).alias("te"),
        smoothed(F.col("g"), n, F.lit(goal_prior), smoothing).alias("goalmean"),
        F.array(*[smoothed(s - F.col(f"s{f}"), n - F.col(f"n{f}"), F.lit(oof_priors[f]), smoothing)
                  for f in range(folds)]).alias("oof"),
    )
    return LevelValues(written(levels, "levels"), te_prior, goal_prior, oof_priors, list(columns))


def level_counts(df: DataFrame, columns: list[str], min_count: int = MIN_LEVEL_COUNT) -> DataFrame:
    """(column, level, n) of the levels with at least `min_count` rows."""
    return (unpivoted(df, columns, []).groupBy("column", "level").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= min_count))


def distinct_levels(df: DataFrame, columns: list[str] = CAT_COLS) -> DataFrame:
    """(column, level): every level seen."""
    return unpivoted(df, columns, []).distinct()


def modal_parent(df: DataFrame) -> DataFrame:
    """category -> its most frequent parent, the smallest on ties."""
    counts = df.groupBy("category", "parent_category").agg(F.count("*").alias("n"))
    best = Window.partitionBy("category").orderBy(F.desc("n"), "parent_category")
    return (counts.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1")
            .select("category", "parent_category"))


def median_rate(df: DataFrame) -> DataFrame:
    """currency -> median USD rate."""
    return quantiles(df, "usd_rate", {"usd_rate": 0.5}, by=("currency",))


def onehot_name(tag: str, position: int, level: str) -> str:
    """Column name of a level: letters, digits and '_' only, at most 30 characters of the level."""
    safe, gap = "", False
    for ch in level:
        if ch.isascii() and (ch.isalnum() or ch == "_"):
            safe, gap = safe + ch, False
        elif not gap:
            safe, gap = safe + "_", True
    return f"m_oh_{tag}{position}_{safe[:30]}"


def onehot_columns(levels: dict[str, list[str]]) -> dict[str, Column]:
    """Name -> 0/1 column for the sorted levels of 'parent_category' and 'category'."""
    out = {}
    for column, tag in (("parent_category", "par"), ("category", "cat")):
        for i, level in enumerate(levels[column]):
            out[onehot_name(tag, i, level)] = F.coalesce(F.col(column) == level, F.lit(False)).cast("double")
    return out


def fit_onehots(df: DataFrame, min_count: int = MIN_LEVEL_COUNT) -> dict[str, list[str]]:
    """Sorted levels per one-hot column; each has at least `min_count` rows."""
    columns = ["parent_category", "category"]
    found = level_counts(df, columns, min_count).select("column", "level").toPandas()
    return {c: sorted(found.loc[found["column"] == c, "level"]) for c in columns}
