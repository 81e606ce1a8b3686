import pytest
from pyspark.sql import functions as F

from launchcohort.functions import scalars as S
from launchcohort.operators import cohort
from launchcohort.operators.encoders import onehot_name
from launchcohort.operators.metrics import violations

RAW = ("id string, name string, blurb string, goal string, state string, country string, currency string, "
       "deadline string, created_at string, launched_at string, static_usd_rate string, category string, "
       "location string, snapshot int, chunk string, row_no bigint")


def row(id="1", snapshot=1, chunk="a", row_no=0, **kw):
    base = dict(id=id, name="n", blurb="b", goal="100", state="successful", country="US", currency="USD",
                deadline="200000", created_at="1", launched_at="100000", static_usd_rate="1.5",
                category='{"name":"Apps","slug":" Tech/apps"}', location='{"name":"Rome","type":"Town"}')
    base.update(kw, snapshot=snapshot, chunk=chunk, row_no=row_no)
    return base


def cleaned(spark, rows, **kw):
    df = spark.createDataFrame([tuple(r[f.split()[0]] for f in RAW.split(", ")) for r in rows], RAW)
    return df, {r["id"]: r for r in cohort.clean(df, **kw).collect()}


def test_funnel_adds_up(raw, cohort_df):
    got = raw.transform(cohort.funnel).first()
    assert got["n_rows_read"] > got["n_unique_ids"]
    assert got["n_final"] < got["n_unique_ids"]
    assert got["n_final"] == cohort_df.count()
    assert got["n_finished"] >= got["n_after_window"] == got["n_final"] + got["n_dropped_name_dupes"]
    found = {r["check"]: r["n"] for r in violations(cohort_df, ["goal_usd", "launched_at", "deadline"]).collect()}
    assert set(found.values()) == {0}


def test_banned_columns_are_found_and_dropped(cohort_df, raw):
    assert not cohort.banned_in(cohort_df) and cohort_df.columns == cohort.CLEAN_COLUMNS
    assert cohort.banned_in(raw) == ["state"]
    assert not cohort.banned_in(cohort.without_banned(raw.withColumn("pledged", F.lit(1))))


def test_latest_row_decides_even_when_it_is_not_final(spark):
    _, got = cleaned(spark, [
        row("1", 1), row("1", 2, state="live"),
        row("2", 1, state="live", name="x"), row("2", 2, state="failed", name="x"),
        row("3", 1, "b", 5, goal="7", name="y"), row("3", 1, "b", 6, goal="9", name="y"), row("3", 1, "a", 99, goal="1", name="y"),
    ])
    assert set(got) == {2, 3}
    assert got[2]["y"] == 0 and got[3]["goal_usd"] == 13.5


def test_bad_values(spark):
    _, got = cleaned(spark, [
        row("1", name=None, blurb=None, country=None, currency=None, category="{bad", location="[1]", static_usd_rate="x"),
        row("2", goal="12d"), row("3", goal="NaN"), row("4", goal="0"), row("5", deadline="100000"),
        row("6", launched_at=None), row("7", category='{"name":"a","slug":', name="q"), row("8", category='"s"', location=None, name="r"),
        row("9", goal=" 5e1 ", name="t"),
    ])
    assert set(got) == {1, 7, 8, 9}
    one = got[1]
    assert (one["name"], one["blurb"], one["country"], one["currency"]) == ("", "", "unknown", "unknown")
    assert (one["category"], one["parent_category"], one["location"], one["location_type"]) == ("unknown",) * 4
    assert one["usd_rate"] == 1.0 and one["goal_usd"] == 100.0
    assert got[7]["category"] == "unknown" and got[8]["parent_category"] == "unknown"
    assert got[9]["goal_usd"] == 75.0 and got[9]["parent_category"] == "tech" and got[9]["category"] == "Apps"


def test_repeats_keep_the_last_row_of_the_files(spark):
    _, got = cleaned(spark, [row("9"), row("10"), row("8", name="other")])
    assert set(got) == {10, 8}
    _, got = cleaned(spark, [row("9", 1, state="failed"), row("2", 2, state="successful")])
    assert {i: r["y"] for i, r in got.items()} == {2: 1}
    _, got = cleaned(spark, [row("9", 2, "a", 7), row("3", 2, "b", 1), row("5", 2, "a", 9)])
    assert set(got) == {3}


def test_values_that_do_not_fit_end_no_job(spark):
    _, got = cleaned(spark, [
        row("1.0", name="a"), row("abc", name="b"), row("3", name="c", launched_at="inf"), row("4", name="d", deadline="1e30"),
        row("5", name="e", deadline="200000.7"), row("6", name="f", category="{'name':'x'}"), row("7", name="g", category='{"name":"x"} junk'),
    ])
    assert set(got) == {1, None, 5, 6, 7} and got[5]["deadline"] == 200000
    assert got[6]["category"] == got[7]["category"] == "unknown"


def test_hot_id_and_hot_repeat_key(spark):
    many = spark.range(3000).select(
        F.when(F.col("id") < 1500, 7).otherwise(F.col("id")).cast("string").alias("id"), F.lit("n").alias("name"),
        F.lit("b").alias("blurb"), F.lit("100").alias("goal"), F.lit("failed").alias("state"), F.lit("US").alias("country"),
        F.lit("USD").alias("currency"), F.lit("200000").alias("deadline"), F.lit("1").alias("created_at"),
        F.lit("100000").alias("launched_at"), F.lit("1").alias("static_usd_rate"), F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("string").alias("location"), F.col("id").alias("snapshot"))
    assert [r["id"] for r in cohort.clean(many).collect()] == [2999]
    plan = cohort.latest_per_id(many)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_launch_window(raw):
    cut = int(raw.agg(F.median(F.col("launched_at").cast("bigint"))).first()[0])
    full = cohort.clean(raw).count()
    part, upper = cohort.clean(raw, cut), cohort.clean(raw, None, cut)
    assert 0 < part.count() < full and 0 < upper.count() < full
    assert part.agg(F.min("launched_at")).first()[0] >= cut
    assert upper.agg(F.max("launched_at")).first()[0] < cut
    got = cohort.profile(part, cut).first()
    assert got["cohort_from"] != "all" and got["cohort_to"] == "all"
    whole = cohort.profile(cohort.clean(raw)).first()
    assert whole["cohort_from"] == whole["cohort_to"] == "all"


def test_result_does_not_depend_on_partitions(raw):
    want = sorted(map(tuple, cohort.clean(raw.repartition(1)).collect()))
    assert sorted(map(tuple, cohort.clean(raw.repartition(13)).collect())) == want


@pytest.mark.parametrize("text,words,parts", [
    ("", 0, [""]), ("  ", 0, ["  "]), ("a b", 2, ["a b"]), ("One. Two!  Three?", 3, ["One.", "Two!", "Three?"]),
    ("x y.z", 2, ["x y.z"]), ("Hi! ", 1, ["Hi!"]),
])
def test_words_and_sentences(spark, text, words, parts):
    got = spark.createDataFrame([(text,)], "t string").select(S.word_count(F.col("t")), S.sentences(F.col("t"))).first()
    assert got[0] == words and got[1] == parts


def test_dates_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = spark.createDataFrame([(1735689599,)], "t bigint").select(S.launch_date(F.col("t")).cast("string"),
                                                                       S.epoch_of_date(F.lit("2025-01-01"))).first()
        assert tuple(got) == ("2024-12-31", 1735689600)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert S.epoch_of("2025-01-01") == 1735689600 and S.epoch_of(None) is None


def test_onehot_names():
    assert onehot_name("cat", 3, "Film & Video/ÄX") == "m_oh_cat3_Film_Video_X"
    assert len(onehot_name("par", 0, "x" * 50)) == len("m_oh_par0_") + 30
