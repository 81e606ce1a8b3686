import numpy as np
import pytest
from pyspark.sql import functions as F

from launchcohort.operators import encoders
from launchcohort.operators.lookup import lookup
from launchcohort.operators.splits import with_fold
from launchcohort.session import written


def naive_out_of_fold(pdf, column, smoothing=20.0):
    """Refits per fold."""
    out = np.zeros(len(pdf))
    for f in pdf["fold"].unique():
        rest, mine = pdf[pdf["fold"] != f], (pdf["fold"] == f).to_numpy()
        prior = rest["y"].mean()
        g = rest.groupby(column)["y"].agg(["sum", "count"])
        means = (g["sum"] + smoothing * prior) / (g["count"] + smoothing)
        out[mine] = pdf.loc[mine, column].map(means).fillna(prior)
    return out


@pytest.fixture(scope="module")
def folded(cohort_df):
    return written(with_fold(cohort_df), "folded")


def test_out_of_fold_equals_refitting(folded):
    got = encoders.fit_levels(folded).encode(folded, out_of_fold=True).toPandas().sort_values("id")
    for c in encoders.CAT_COLS:
        assert got[f"m_te_{c}"].to_numpy() == pytest.approx(naive_out_of_fold(got, c), abs=1e-12)


def test_a_level_of_its_own_gets_the_prior_of_the_other_folds(folded):
    lone = int(folded.agg(F.min("id")).first()[0])
    df = folded.withColumns({
        "location": F.when(F.col("id") == lone, "nowhere else").otherwise(F.col("location")),
        "y": F.when(F.col("id") == lone, 1).otherwise(F.col("y"))})
    fitted = encoders.fit_levels(df)
    row = fitted.encode(df, out_of_fold=True).filter(F.col("id") == lone).first()
    prior = df.filter(F.col("fold") != row["fold"]).agg(F.avg("y")).first()[0]
    assert row["m_te_location"] == pytest.approx(prior, rel=1e-9)
    full = fitted.encode(df).filter(F.col("id") == lone).first()["m_te_location"]
    assert full > row["m_te_location"]


def test_own_label_does_not_matter(folded):
    ids = [r["id"] for r in folded.orderBy("id").limit(3).collect()]
    for i in ids:
        flipped = folded.withColumn("y", F.when(F.col("id") == i, 1 - F.col("y")).otherwise(F.col("y")))
        one, two = (encoders.fit_levels(d).encode(d, out_of_fold=True).filter(F.col("id") == i).first() for d in (folded, flipped))
        assert [one[f"m_te_{c}"] for c in encoders.CAT_COLS] == [two[f"m_te_{c}"] for c in encoders.CAT_COLS]


def test_without_smoothing_unseen_levels_get_the_prior(folded):
    fitted = encoders.fit_levels(folded, smoothing=0.0)
    got = fitted.encode(folded.withColumn("location", F.lit("new")), out_of_fold=True)
    assert got.filter(F.col("m_te_location").isNull() | F.isnan("m_te_location")).isEmpty()


def test_partitions_do_not_matter(folded):
    a, b = (encoders.fit_levels(folded.repartition(n)).encode(folded).orderBy("id").select("m_te_location", "m_goalmean_category").collect()
            for n in (1, 29))
    assert np.array(a) == pytest.approx(np.array(b), abs=1e-9)


def test_lookup_beyond_broadcast_is_the_same_with_hot_keys(spark):
    """A third of the rows share one level, another part has none or an unknown one."""
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
                                    .when(F.col("id") % 50 == 2, "unseen").otherwise(F.concat(F.lit("l"), F.col("id") % 4000)).alias("k"))
    table = written(rows.filter("k is not null and k <> 'unseen'").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("v")), "t")
    small = lookup(rows, table, "k").select("id", "k", "n", "v")
    large = lookup(rows, table, "k", rows_of="n", limit=0).select("id", "k", "n", "v")
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    plain = lookup(rows, table, "k", limit=0).select("id", "k", "n", "v")
    assert sorted(map(str, plain.collect())) == sorted(map(str, small.collect()))


def test_modal_parent_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("c", "b"), ("c", "a"), ("d", "z"), ("d", "z"), ("d", "a")], "category string, parent_category string")
    assert {r[0]: r[1] for r in encoders.modal_parent(df).collect()} == {"c": "a", "d": "z"}
