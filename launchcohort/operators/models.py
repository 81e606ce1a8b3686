"""The eight compared classifiers, balanced weights, scoring, search and importances."""

from __future__ import annotations

import random
from dataclasses import asdict, dataclass, replace

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchcohort.functions.scalars import key_hash
from launchcohort.operators.boosting import fit_boosting
from launchcohort.operators.splits import fold_of, sample_rows
from launchcohort.session import shared_dir, written

BEST = "G. Boosting"


@dataclass(frozen=True)
class Boosting:
    """The boosting defaults. Trees grow by level here, so 127 leaves become depth 7."""

    trees: int = 500
    rate: float = 0.05
    depth: int = 7
    min_rows: int = 30
    row_share: float = 0.75
    column_share: float = 0.5
    bins: int = 255

    def estimator(self, seed: int) -> GBTClassifier:
        return GBTClassifier(
            labelCol="y", featuresCol="features", weightCol="weight", seed=seed, maxIter=self.trees,
            stepSize=self.rate, maxDepth=self.depth, minInstancesPerNode=self.min_rows, maxBins=self.bins,
            subsamplingRate=self.row_share, featureSubsetStrategy=str(self.column_share))


class StoppedNet(Estimator):
    """A net that stops when rows held apart gain no more.

    Every round trains for the net's own number of steps, from the weights the last one ended with, and is
    measured by its mean log loss on a tenth of the rows, chosen by the hash of the id so that repeats of a
    row stay on one side. After `patience` rounds that lower the best loss by less than `tol`, the weights
    of the best round are the model. `losses` holds the loss of every round of the last fit.
    """

    def __init__(self, net: MultilayerPerceptronClassifier, rounds: int, patience: int = 2, tol: float = 1e-4,
                 held: int = 10, seed: int = 42):
        super().__init__()
        self.net, self.rounds, self.patience, self.tol, self.held, self.seed = net, rounds, patience, tol, held, seed
        self.losses: list[float] = []

    def _fit(self, df: DataFrame) -> Model:
        apart = fold_of(F.col("id"), self.held, self.seed + 3) == 0
        rows = written(df.select("y", self.net.getFeaturesCol(), apart.alias("apart")), "net-rows")
        train, check = rows.where(~F.col("apart")), rows.where("apart")
        if check.isEmpty() or train.isEmpty():  # too few rows to hold any apart
            return self.net.copy({self.net.maxIter: self.net.getMaxIter() * self.rounds}).fit(rows)
        self.losses, best, model, waited = [], None, None, 0
        for _ in range(self.rounds):
            start = self.net if model is None else self.net.copy({self.net.initialWeights: model.weights})
            model = start.fit(train)
            right = F.get(vector_to_array("probability"), F.col("y").cast("int"))
            loss = model.transform(check).agg(F.avg(-F.log(F.greatest(right, F.lit(1e-15))))).first()[0]
            self.losses.append(loss)
            waited = 0 if best is None or loss < min(self.losses[:-1]) - self.tol else waited + 1
            if best is None or loss <= min(self.losses):
                best = model
            if waited >= self.patience:
                break
        return best


@dataclass(frozen=True)
class Zoo:
    """Sizes of the other models."""

    boosting: Boosting = Boosting()
    forest_trees: int = 200
    forest_depth: int = 30
    net_units: int = 25
    net_steps: int = 100
    net_round: int = 5
    net_patience: int = 2
    steps: int = 500

    def estimators(self, n_rows: int, n_features: int, seed: int = 42) -> dict[str, Estimator]:
        """Penalties are per mean loss here, so the per-sum penalties are divided by the rows.

        The linear estimators scale features themselves, with the same effect as a scaler before
        them, and stop at a tolerance of 1e-4. Least squares also scales the label, whose balanced deviation is 1/2.
        """
        common = dict(labelCol="y", featuresCol="features", weightCol="weight")
        until = dict(maxIter=self.steps, tol=1e-4)

        def linear(penalty: float, l1: float) -> LinearRegression:
            return LinearRegression(regParam=penalty, elasticNetParam=l1, **until, **common)

        net = MultilayerPerceptronClassifier(
            labelCol="y", featuresCol="scaled", layers=[n_features, self.net_units, 2],
            maxIter=self.net_round, seed=seed)
        stopped = StoppedNet(net, rounds=-(-self.net_steps // self.net_round), patience=self.net_patience, seed=seed)
        scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
        return {
            BEST: self.boosting.estimator(seed),
            "R. Forest": RandomForestClassifier(
                numTrees=self.forest_trees, maxDepth=self.forest_depth, minInstancesPerNode=10,
                featureSubsetStrategy="sqrt", seed=seed, **common),
            "Neural Net": Pipeline(stages=[scaler, stopped]),
            "SVM": LinearSVC(regParam=1.0 / n_rows, **until, **common),
            "Logistic": LogisticRegression(regParam=1.0 / (0.1 * n_rows), **until, **common),
            "Ridge": linear(0.5 / n_rows, 0.0),
            "OLS": linear(0.0, 0.0),
            "Lasso": linear(1e-4, 1.0),
        }


def assembled(df: DataFrame, columns: list[str]) -> DataFrame:
    """(id, y, features) with the vector of `columns`."""
    joined = VectorAssembler(inputCols=columns, outputCol="features").transform(df)
    return joined.select(*[c for c in ("id", "y") if c in df.columns], "features")


def class_weights(df: DataFrame) -> DataFrame:
    """(y, weight): rows / (classes * rows of the class)."""
    counts = df.groupBy("y").agg(F.count("*").alias("n"))
    all_rows, classes = (counts.agg(a).scalar() for a in (F.sum("n").alias("n"), F.count("*").alias("k")))
    return counts.select("y", (all_rows / (classes * F.col("n"))).alias("weight"))


def balanced(df: DataFrame) -> DataFrame:
    """Adds `weight`; the two class weights are looked up once and put into the plan."""
    weight = F.lit(None).cast("double")
    for row in class_weights(df).collect():
        weight = F.when(F.col("y") == row["y"], F.lit(float(row["weight"]))).otherwise(weight)
    return df.withColumn("weight", weight)


def repeated_by_weight(df: DataFrame, seed: int = 42) -> DataFrame:
    """Balance for estimators without weights: rows of the smaller class come more than once.

    The lowest weight counts as one row, so no row is lost; what a weight has beyond whole rows is
    given to that share of the rows, chosen by hash of the id.
    """
    least = df.agg(F.min("weight")).first()[0]
    times = F.col("weight") / F.lit(least)
    extra = (key_hash(F.col("id"), seed) / F.lit(float(1 << 32)) < times - F.floor(times)).cast("int")
    return df.withColumn("_n", F.explode(F.sequence(F.lit(1), (F.floor(times) + extra).cast("int")))).drop("_n")


def fit_model(estimator: Estimator, train: DataFrame, seed: int = 42) -> Model:
    """Fits on (id, y, weight, features), with balanced weights or balanced repeats."""
    shared_dir(train.sparkSession)  # long boosting runs cut their lineage there
    if isinstance(estimator, GBTClassifier):
        return fit_boosting([(estimator, None)], train)[0]
    last = estimator.getStages()[-1] if isinstance(estimator, Pipeline) else estimator
    return estimator.fit(train if last.hasParam("weightCol") else repeated_by_weight(train, seed))


def score(model: Model, df: DataFrame, name: str) -> DataFrame:
    """(model, id, y, score, pred). Least-squares models predict 1 from an output of 0.5 on."""
    out = model.transform(df)
    if "probability" in out.columns:
        value = vector_to_array("probability")[1]
    elif "rawPrediction" in out.columns:
        value = vector_to_array("rawPrediction")[1]
    else:
        value = F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0))
    pred = (F.col("prediction") >= 0.5).cast("int")
    return out.select(F.lit(name).alias("model"), "id", "y", value.alias("score"), pred.alias("pred"))


def scaler_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, mean, std) as the fitted standard scaler holds them."""
    model = StandardScaler(inputCol="features", outputCol="scaled", withMean=True).fit(assembled(df, columns))
    rows = [(c, float(m), float(s)) for c, m, s in zip(columns, model.mean, model.std)]
    return df.sparkSession.createDataFrame(rows, "feature string, mean double, std double")


def importances(model: Model, columns: list[str], spark) -> DataFrame:
    """(feature, gain): share of the split gain per feature."""
    rows = [(c, float(v)) for c, v in zip(columns, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, gain double")


# The searched grid and the number of draws.
GRID = {
    "depth": [5, 6, 7, 8], "rate": [0.03, 0.05, 0.1], "trees": [200, 400, 600],
    "min_rows": [10, 30, 60], "column_share": [0.3, 0.5, 0.8],
}
SEARCH_DRAWS = 12


def draw_settings(grid: dict[str, list], draws: int, seed: int) -> list[dict]:
    """Distinct random settings of the grid."""
    total = 1
    for values in grid.values():
        total *= len(values)
    settings = []
    for place in random.Random(seed).sample(range(total), min(draws, total)):
        setting = {}
        for name, values in grid.items():
            place, pick = divmod(place, len(values))
            setting[name] = values[pick]
        settings.append(setting)
    return settings


def search_boosting(train: DataFrame, start: Boosting = Boosting(), grid: dict[str, list] | None = None,
                    draws: int = SEARCH_DRAWS, rows: int | None = None, folds: int = 3, seed: int = 42,
                    ) -> tuple[Boosting, DataFrame]:
    """Random search by cross-validated accuracy, unweighted, on all training rows or a sample of `rows` of them."""
    sample = written((train if rows is None else sample_rows(train, rows, seed)).withColumns(
        {"weight": F.lit(1.0), "search_fold": fold_of(F.col("id"), folds, seed + 1)}), "search-rows")
    settings = [replace(start, **s) for s in draw_settings(grid or GRID, draws, seed)]
    jobs = [(s.estimator(seed), fold) for s in settings for fold in range(folds)]
    found = fit_boosting(jobs, sample, "search_fold")
    shares = [
        model.transform(sample.where(F.col("search_fold") == fold)).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0] or 0.0
        for model, (_, fold) in zip(found, jobs)]
    accuracy = [sum(shares[i * folds:(i + 1) * folds]) / folds for i in range(len(settings))]
    tried = [{**asdict(s), "accuracy": float(a)} for s, a in zip(settings, accuracy)]
    best = settings[max(range(len(settings)), key=lambda i: accuracy[i])]
    table = train.sparkSession.createDataFrame(tried, ", ".join(
        f"{k} {'double' if isinstance(v, float) else 'int'}" for k, v in tried[0].items()))
    return best, table.orderBy(F.desc("accuracy"))
