import numpy as np
import pytest
from pyspark.sql import functions as F

from launchcohort.operators import ranking, splits


@pytest.fixture(scope="module")
def values(spark):
    """A third of the rows share one value."""
    return spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(100000)) / 1000.0).alias("v"),
        F.when(F.col("id") % 10 < 6, "a").otherwise("b").alias("g"))


def test_quantiles_equal_numpy(values):
    shares = {"p025": 0.025, "median": 0.5, "p9": 0.9, "low": 0.0, "high": 1.0}
    got = ranking.quantiles(values, "v", shares).first()
    data = values.toPandas()
    for name, s in shares.items():
        assert got[name] == pytest.approx(np.quantile(data["v"], s), abs=1e-12)


def test_grouped_quantiles(values):
    got = {r["g"]: r["m"] for r in ranking.quantiles(values, "v", {"m": 0.5}, by=("g",)).collect()}
    want = values.toPandas().groupby("g")["v"].median().to_dict()
    assert got == pytest.approx(want)


def test_running_totals(values):
    counts = values.groupBy("v").agg(F.count("*").alias("n"))
    got = ranking.running_totals(counts, "v", "n").toPandas().sort_values("v")
    assert (got["upto"].to_numpy() == got["n"].cumsum().to_numpy()).all()
    assert (got["total_all"] == 6000).all()


@pytest.mark.parametrize("rank", [1, 2, 1999, 2000, 2001, 6000, 6001, 0])
def test_key_at_rank(values, rank, monkeypatch):
    monkeypatch.setattr(ranking, "SMALL", 100)
    levels = [F.floor("v"), F.floor(F.col("v") * 1000) % 1000, *ranking.digits(F.col("id"))]
    got = ranking.key_at_rank(values, rank, levels)
    keys = sorted(map(tuple, values.select(*levels).collect()))
    assert got == (list(keys[rank - 1]) if 1 <= rank <= 6000 else None)


@pytest.mark.parametrize("mode", ["random", "temporal"])
def test_split_is_exact_with_a_hot_launch_second(spark, mode, monkeypatch):
    monkeypatch.setattr(ranking, "SMALL", 50)
    df = spark.range(1000, 2003).select("id", F.when(F.col("id") % 2 == 0, 86400 * 50).otherwise(F.col("id") * 4000).alias("launched_at"))
    train, test = splits.split_data(df, mode)
    a, b = train.toPandas(), test.toPandas()
    assert len(a) == int(1003 * 0.7) and len(a) + len(b) == 1003 and not set(a["id"]) & set(b["id"])
    if mode == "temporal":
        assert max(zip(a["launched_at"], a["id"])) < min(zip(b["launched_at"], b["id"]))
    again = splits.split_data(df.repartition(17), mode)[0].toPandas()
    assert set(again["id"]) == set(a["id"])


def test_sample_and_folds(spark):
    df = spark.range(5000)
    assert splits.sample_rows(df, 700).count() == 700
    assert splits.sample_rows(df, 9000).count() == 5000
    sizes = [r["n"] for r in splits.with_fold(df).groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 5 and min(sizes) > 850
