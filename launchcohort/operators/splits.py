"""Train/test splits, folds and samples that depend on row values only, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from launchcohort.functions.scalars import key_hash
from launchcohort.operators.ranking import digits, key_at_rank, up_to


def random_levels(seed: int) -> list[Column]:
    hashed = key_hash(F.col("id"), seed)
    return [F.shiftright(hashed, 16), hashed.bitwiseAND(F.lit(65535)), *digits(F.col("id"))]


def launch_levels() -> list[Column]:
    return [*digits(F.col("launched_at")), *digits(F.col("id"))]


def with_split(df: DataFrame, mode: str = "random", test_size: float = 0.3, seed: int = 42) -> DataFrame:
    """Adds `split`: exactly int(n * (1 - test_size)) rows are 'train'.

    'random' orders by a hash of the id, 'temporal' by launch. Only the key of the last training
    row is looked up; the rows are then marked in place, without a shuffle.
    """
    levels = launch_levels() if mode == "temporal" else random_levels(seed)
    n_train = int(df.count() * (1 - test_size))
    bound = key_at_rank(df, n_train, levels)
    return df.withColumn("split", F.when(up_to(levels, bound), "train").otherwise("test"))


def split_data(df: DataFrame, mode: str = "random", test_size: float = 0.3,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, mode, test_size, seed)
    return (marked.filter("split = 'train'").drop("split"), marked.filter("split = 'test'").drop("split"))


def fold_of(key: Column, folds: int = 5, seed: int = 42) -> Column:
    return F.pmod(key_hash(key, seed), F.lit(folds)).cast("int")


def with_fold(df: DataFrame, folds: int = 5, seed: int = 42) -> DataFrame:
    return df.withColumn("fold", fold_of(F.col("id"), folds, seed))


def sample_rows(df: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """`size` rows without replacement (all rows when there are fewer)."""
    levels = random_levels(seed)
    n = df.count()
    return df if n <= size else df.filter(up_to(levels, key_at_rank(df, size, levels)))


def split_summary(df: DataFrame) -> DataFrame:
    """Sizes, success rates and the majority baseline of a split cohort, as one row."""
    rates = df.groupBy("split").agg(F.count("*").alias("n"), F.avg("y").alias("rate"))

    def of(split: str, column: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(column)))

    test = of("test", "rate")
    return rates.agg(
        of("train", "n").alias("n_train"), of("test", "n").alias("n_test"),
        of("train", "rate").alias("train_success_rate"), test.alias("test_success_rate"),
        F.greatest(test, 1 - test).alias("baseline_acc"),
    )
