import numpy as np
import pytest
from pyspark.sql import functions as F

from launchcohort.operators import scenarios
from launchcohort.plans import features
from launchcohort.session import written


def test_ladder_texts_are_computed_once_per_row(spark, prepared, cohort_df, monkeypatch):
    rows = written(cohort_df.orderBy("id").limit(9).drop("y").withColumn("id", F.col("id") + (1 << 57)), "ladder-rows")
    asked = []
    count = features.TextModel.nb_probability
    monkeypatch.setattr(features.TextModel, "nb_probability", lambda self, df: asked.append(df.count()) or count(self, df))
    fitted = prepared.features
    got = fitted.transform_ladder(rows, ["meta", "nb"])
    assert asked == [9] and got.columns == ["id", *fitted.columns_for(["meta", "nb"])]
    want = fitted.transform(scenarios.ladder(rows), ["meta", "nb"])
    one, two = (np.array(df.orderBy("id").collect()) for df in (got, want))
    assert one.shape == (63, len(got.columns)) and one == pytest.approx(two, abs=1e-12)


def test_base_id(spark):
    ids = [-5, -1, 0, 3, (1 << 60) + 1]
    rungs = scenarios.ladder(spark.createDataFrame([(i, 1.0) for i in ids], "id bigint, goal_usd double"))
    assert rungs.where(~scenarios.base_id(F.col("id")).eqNullSafe(F.col("base_id"))).count() == 0 and rungs.count() == 35
