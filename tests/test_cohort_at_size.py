"""What the cleaning shuffles and how many rows its tasks hold."""

import re

from pyspark.sql import functions as F

from launchcohort.catalog import tables as T
from launchcohort.operators import cohort, reporting


def tables(spark, folder, n=400):
    """The tables campaigns are made of, with `n` orders."""
    made = {
        "orders": spark.range(n).select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 10).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            (F.col("id") + 100.0).alias("o_totalprice"), F.timestamp_seconds(F.col("id") * 86400 + 852076800).alias("o_orderdate"),
            F.lit("1-URGENT").alias("o_orderpriority")),
        "customer": spark.range(10).select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), "id").alias("c_name"),
                                           F.lit(0).alias("c_nationkey"), F.lit("AUTO").alias("c_mktsegment")),
        "nation": spark.sql("select 0 n_nationkey, 'N' n_name, 0 n_regionkey"),
        "region": spark.sql("select 0 r_regionkey, 'R' r_name"),
        "part": spark.range(7).select(F.col("id").alias("p_partkey"), F.concat(F.lit("p"), "id").alias("p_name")),
        "benchmark": spark.range(5).select(F.col("id").alias("item_id"), F.concat(F.lit("text "), "id").alias("text")),
    }
    for name, df in made.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_grow_with_the_ids_and_the_newest_row_needs_no_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "IDS_PER_TASK", 10)
    raw = T.campaigns_raw(spark, tables(spark, str(tmp_path)))
    assert raw.rdd.getNumPartitions() == 41
    # The window of the newest row lies right above the spread rows, which have no snapshots yet.
    above = plan_of(cohort.latest_per_id(raw)).split("Generate explode")[0]
    assert "Window" in above and "Exchange" not in above


def test_texts_travel_only_where_they_are_asked_for(spark, tmp_path):
    clean = cohort.clean(T.campaigns_raw(spark, tables(spark, str(tmp_path))))
    plan = plan_of(reporting.rate_by_parent(clean))
    key = re.search(r"Exchange hashpartitioning\(launched_at[^\n]*", plan).group(0)
    assert "_texts" in key and "blurb" not in key and "name" not in key


def test_the_dump_is_the_snapshots_in_order(spark, tmp_path):
    folder = tables(spark, str(tmp_path))
    raw = T.campaigns_raw(spark, folder)
    for i in (1, 2, 3):
        alone = T.campaigns_raw(spark, folder, i)
        order = [c for c in raw.columns]
        assert sorted(map(str, alone.select(order).collect())) == sorted(map(str, raw.filter(F.col("snapshot") == i).collect()))
        assert "Exchange" not in plan_of(alone.sort("chunk", "row_no")).split("BroadcastHashJoin")[0]


def test_texts_digest_parts_names_from_blurbs(spark):
    rows = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "x"), ("", "x"), ("x", None)], "name string, blurb string")
    got = [bytes(r[cohort.TEXTS]) for r in cohort.with_texts_digest(rows).collect()]
    assert got[0] != got[1] and got[2] == got[3] != got[4] and len(got[0]) == 16
