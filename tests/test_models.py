import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from launchcohort.functions.scalars import epoch_of
from launchcohort.operators import contributions, encoders, metrics, models, scenarios
from launchcohort.operators.models import BEST, Boosting, Zoo
from launchcohort.operators.splits import fold_of
from launchcohort.plans import experiment, features
from launchcohort.session import written

SMALL = Zoo(Boosting(trees=20, depth=4, bins=32), forest_trees=10, forest_depth=8, net_steps=25, steps=50)


@pytest.fixture(scope="module")
def final(prepared):
    return experiment.final_model(prepared, SMALL.boosting)


def test_train_and_test_have_the_same_columns_and_no_holes(prepared, cohort_df):
    p = prepared
    assert p.train.columns == p.test.columns == ["id", "y", *p.features.columns]
    assert p.train.count() == int(cohort_df.count() * 0.7)
    for df in (p.train, p.test):
        found = metrics.violations(df, p.features.columns).filter("n > 0").collect()
        assert not found
    one = p.features.transform(cohort_df.limit(1).drop("y"), ["meta", "nb"])
    assert one.columns == ["id", *p.features.columns_for(["meta", "nb"])] and one.count() == 1
    assert [b for b in features.PREFIX if p.features.columns_for([b])] == list(features.PREFIX)


def test_blocks_are_computed_only_when_asked_for(prepared, cohort_df):
    plan = prepared.features.transform(cohort_df, ["meta"])._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "terms" not in plan and "UDF" not in plan


def test_boosting_beats_chance(final):
    got = metrics.model_table(final.predictions).first()
    assert got["AUC"] > 0.65 and got["A"] == pytest.approx(final.accuracy)


def test_model_table_and_significance(prepared):
    table = experiment.run_model_table(prepared, ["meta", "nb"], SMALL).toPandas()
    assert len(table) == 8 and table["A"].is_monotonic_decreasing and (table["AUC"] > 0.6).all()
    assert (table["seconds"] >= 0).all()


def test_ablation_and_tests(prepared):
    runs, summary = experiment.run_ablation(prepared, Boosting(trees=3, depth=3, bins=16), seeds=2)
    assert runs.count() == 10 and [r["sample"] for r in summary.collect()] == list(features.SAMPLES)
    got = experiment.run_significance(prepared, SMALL, 200, with_models=False,
                                      samples={k: features.SAMPLES[k] for k in ("S1_meta", "S2_nb")}).collect()
    assert [(r["A"], r["B"]) for r in got] == [("S2_nb", "S1_meta")]


def test_search(prepared):
    train = models.assembled(prepared.train, prepared.features.columns_for(["meta"]))
    grid = {"depth": [2, 3], "trees": [2, 3], "rate": [0.1]}
    best, table = models.search_boosting(train, Boosting(bins=16), grid, draws=3, rows=600)
    rows = table.collect()
    assert len(rows) == 3 and len({(r["depth"], r["trees"]) for r in rows}) == 3
    assert rows[0]["accuracy"] >= rows[-1]["accuracy"] > 0.4 and best.depth == rows[0]["depth"]


def test_class_weights_and_repeats(spark):
    df = spark.range(1000).select("id", (F.col("id") < 700).cast("int").alias("y"))
    assert {r["y"]: r["weight"] for r in models.class_weights(df).collect()} == {1: pytest.approx(1000 / 1400), 0: pytest.approx(1000 / 600)}
    repeated = models.repeated_by_weight(models.balanced(df))
    n = {r["y"]: r["n"] for r in repeated.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert repeated.select("id").distinct().count() == 1000 and n[1] == 700 and abs(n[0] - 700) < 40


def test_linear_models_have_their_closed_forms(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2)) * [1.0, 5.0] + 3
    y = (x[:, 0] + 0.1 * x[:, 1] + rng.normal(size=300) > 4.2).astype(int)
    rows = [(i, int(b), float(u), float(v)) for i, (b, (u, v)) in enumerate(zip(y, x))]
    df = models.balanced(models.assembled(spark.createDataFrame(rows, "id bigint, y int, a double, b double"), ["a", "b"]))
    fitted = {n: e.fit(df) for n, e in Zoo(steps=200).estimators(300, 2).items() if n in ("OLS", "Ridge")}
    w = np.where(y == 1, 300 / (2 * y.sum()), 300 / (2 * (300 - y.sum())))
    mean = (w[:, None] * x).sum(0) / w.sum()
    for name, alpha in (("OLS", 0.0), ("Ridge", 1.0)):
        scale = np.sqrt((w[:, None] * (x - mean) ** 2).sum(0) / w.sum())
        z = (x - mean) / scale
        beta = np.linalg.solve(z.T @ (w[:, None] * z) + alpha * np.eye(2), z.T @ (w * (y - (w * y).sum() / w.sum())))
        assert fitted[name].coefficients.toArray() == pytest.approx(beta / scale, rel=2e-3)
    scored = models.score(fitted["OLS"], df, "OLS").toPandas()
    assert scored["score"].between(0, 1).all() and ((scored["score"] >= 0.5) == (scored["pred"] == 1)).all()


def test_net_stops_on_rows_held_apart(spark):
    """Few rows, many columns of noise: further steps only learn the rows by heart."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 40))
    y = (x[:, 0] + rng.normal(size=300) * 1.5 > 0).astype(int)
    rows = [(i, int(b), Vectors.dense(v)) for i, (b, v) in enumerate(zip(y, x))]
    df = models.balanced(spark.createDataFrame(rows, ["id", "y", "features"]))
    net = Zoo(net_steps=200).estimators(300, 40)["Neural Net"]
    stopped = net.getStages()[-1]
    fitted = models.fit_model(net, df)
    losses = stopped.losses
    assert 2 < len(losses) < 40 and min(losses) < losses[-1]
    # The model is the best round's, not the last one's.
    scaled = fitted.transform(models.repeated_by_weight(df)).where(fold_of(F.col("id"), 10, 45) == 0)
    right = F.get(vector_to_array("probability"), F.col("y").cast("int"))
    assert scaled.agg(F.avg(-F.log(right))).first()[0] == pytest.approx(min(losses), rel=1e-6)
    # Ten rows or fewer: nothing to hold apart, the steps run as they are.
    few = models.fit_model(Zoo(net_steps=10).estimators(3, 40)["Neural Net"], df.where("id in (1, 2, 3)"))
    assert few.transform(df).count() == 300


def brute_shapley(tree_leaves, x):
    used = sorted({f for leaf in tree_leaves for f in leaf.features})

    def value(known):
        total = 0.0
        for leaf in tree_leaves:
            weight = leaf.value
            for f, low, high, share in zip(leaf.features, leaf.low, leaf.high, leaf.share):
                weight *= float(low < x[f] <= high) if f in known else share
            total += weight
        return total

    out = np.zeros(len(x))
    for f in used:
        rest = [g for g in used if g != f]
        for size in range(len(rest) + 1):
            for s in combinations(rest, size):
                part = math.factorial(size) * math.factorial(len(rest) - size) / math.factorial(len(used))
                out[f] += part * (value({*s, f}) - value(set(s)))
    return out


def test_contributions_are_shapley_values_and_add_up(spark, prepared, final):
    test = models.assembled(prepared.test, final.columns)
    got = contributions.boosting_contributions(final.model, test, final.columns).toPandas().sort_values("id")
    sums = np.array(got["contributions"].tolist()).sum(axis=1)
    assert got["bias"].to_numpy() + sums == pytest.approx(got["raw"].to_numpy(), abs=1e-9)
    nodes = contributions.tree_nodes(final.model, spark)
    one = contributions.leaves(nodes[nodes["treeID"] == 1])
    rows = np.array([r["features"].toArray() for r in test.orderBy("id").limit(5).collect()])
    fast = contributions.shapley(one, rows)
    for x, values in zip(rows, fast):
        assert values == pytest.approx(brute_shapley(one, x), abs=1e-10)


def test_contributions_of_deep_paths():
    """More patterns than rows, and more features than a number has bits."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(6, 70))
    made = []
    for m in (1, 9, 11):
        f = np.sort(rng.choice(70, m, replace=False))
        made.append(contributions.Leaf(float(rng.normal()), f, np.full(m, -1.0), np.full(m, 0.8), rng.uniform(0.2, 0.9, m)))
    for row, values in zip(x, contributions.shapley(made, x)):
        want = sum(brute_shapley([leaf], row) for leaf in made)
        assert values == pytest.approx(want, abs=1e-10)
    wide = contributions.Leaf(2.0, np.arange(70), np.full(70, -9.0), np.where(np.arange(70) % 2, 9.0, -8.0), np.full(70, 0.97))
    values = contributions.shapley([wide], x)
    # Features that agree get equal shares, and so do those that do not; together they are what the leaf gives less its mean.
    assert np.ptp(values[:, 1::2]) < 1e-12 and values.sum(axis=1) == pytest.approx(-2.0 * 0.97 ** 70)


def test_top_contributions(spark):
    df = spark.createDataFrame([(1, [0.5, -2.0, 1.0])], "id bigint, contributions array<double>")
    got = contributions.top_contributions(df, ["a", "b", "c"], 2).orderBy("place").collect()
    assert [(r["place"], r["feature"], r["contribution"]) for r in got] == [(1, "b", -2.0), (2, "c", 1.0)]


def test_importances(spark, final):
    top = metrics.top(models.importances(final.model, final.columns, spark), "gain", 15, "feature").collect()
    assert len(top) == 15 and top[0]["gain"] >= top[-1]["gain"]


def test_bundle_survives_saving(spark, prepared, cohort_df, tmp_path):
    folder = str(tmp_path / "bundle")
    prepared.features.save(folder, test_accuracy=0.7)
    loaded, facts = features.load_features(spark, folder)
    assert facts == {"test_accuracy": 0.7} and loaded.columns == prepared.features.columns
    rows = cohort_df.orderBy("id").limit(20)
    one, two = (np.array(f.transform(rows).orderBy("id").drop("id", "y").collect()) for f in (prepared.features, loaded))
    assert two == pytest.approx(one, abs=1e-9)


def test_saved_classifier_scores_as_before(spark, prepared, final, cohort_df, tmp_path):
    folder = str(tmp_path / "whole")
    experiment.save_bundle(folder, prepared.features, final, source="here")
    loaded = experiment.load_bundle(spark, folder)
    assert loaded.facts == {"blocks": features.SAMPLES["S2_nb"], "test_accuracy": final.accuracy, "source": "here"}
    again = loaded.score(cohort_df).select("id", F.col("score").alias("again"))
    both = final.predictions.join(again, "id").toPandas()
    assert len(both) == final.predictions.count() and both["again"].to_numpy() == pytest.approx(both["score"].to_numpy(), abs=1e-9)


def test_scenarios(spark, prepared, final):
    rows = spark.createDataFrame([
        (1, "Bade", "Fika lego sunlit sunlit sunlit sunlit", "Craft North", "US", "USD", 5000.0, "2020-03-01", 30, "  ", "Town"),
        (2, "Hupu", "Nomi frosty frosty frosty frosty", "Code South", "XX", "XXX", 120000.0, "2020-03-01", 60, "Town 3", "Town"),
    ], "id bigint, name string, blurb string, category string, country string, currency string, goal double, launch string, "
       "days int, location string, location_type string")
    ready = written(scenarios.cohort_rows(rows, prepared.features.cat_parent, prepared.features.currency_rate), "plans")
    one, two = ready.orderBy("id").collect()
    assert one["location"] == "unknown" and one["parent_category"] == "craft" and one["launched_at"] == epoch_of("2020-03-01") + 43200
    assert one["deadline"] - one["launched_at"] == 30 * 86400 and two["usd_rate"] == 1.0
    rungs = written(scenarios.ladder(ready), "rungs")
    assert rungs.count() == 14 and rungs.select("id").distinct().count() == 14
    inputs = models.assembled(prepared.features.transform(rungs, ["meta", "nb"]), final.columns).withColumn("y", F.lit(0))
    scored = models.score(final.model, inputs, BEST).join(rungs, "id").toPandas().sort_values("multiplier")
    for _, steps in scored.groupby("base_id"):
        assert steps["score"].iloc[0] > steps["score"].iloc[-1]


def test_median_rate(cohort_df):
    got = {r["currency"]: r["usd_rate"] for r in encoders.median_rate(cohort_df).collect()}
    assert got == pytest.approx(cohort_df.toPandas().groupby("currency")["usd_rate"].median().to_dict())
