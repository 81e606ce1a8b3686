"""Views of the given tables in the shape of campaign snapshots, labelled texts and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchcohort.functions.scalars import DAY, key_hash
from launchcohort.operators.cohort import clean

RAW_COLUMNS = [
    "id", "name", "blurb", "goal", "state", "country", "currency", "deadline", "created_at",
    "launched_at", "static_usd_rate", "category", "location", "snapshot", "chunk", "row_no",
]
# Pseudo-models and how many percent of the labels each gets right.
PSEUDO_MODELS = {"G. Boosting": 82, "Logistic": 80, "R. Forest": 79, "OLS": 78, "Chance": 50}
IDS_PER_TASK = 100_000
# The cohort bounds of the windowed queries.
LAUNCH_FROM, LAUNCH_TO = "1996-01-01", "2001-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int):
    return F.col("id") % n == 0


def campaigns_raw(spark: SparkSession, sf_dir: str, snapshot: int | None = None) -> DataFrame:
    """Orders as three cumulative snapshots, with the bad values a scraped dump has.

    With `snapshot` only that one, spread by range in the order of its rows in the dump.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    part = table(spark, sf_dir, "part")
    items = table(spark, sf_dir, "benchmark")
    n_orders = orders.agg(F.count("*").alias("n")).scalar()
    n_parts = part.agg(F.count("*").alias("n")).scalar()
    n_items = items.agg(F.count("*").alias("n")).scalar()

    seconds = (F.hour("o_orderdate") * 3600 + F.minute("o_orderdate") * 60 + F.second("o_orderdate"))
    ordered = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * DAY + seconds
    base = (
        orders.withColumn("id", F.col("o_orderkey"))
        .withColumn("repeats", _every(53))
        .withColumn("launch", F.when(F.col("repeats"), F.lit(852076800)).otherwise(ordered))
        .withColumn("days", F.when(F.col("repeats"), 30).when(_every(61), 0).otherwise(15 + F.col("id") % 46))
        .withColumn("part_no", F.when(F.col("repeats"), F.col("id") % 3).otherwise(F.col("id") % n_parts))
        .withColumn("item_no", F.when(F.col("repeats"), F.col("id") % 2).otherwise(F.col("id") % n_items))
        .withColumn("first_snapshot", F.when(F.col("id") < n_orders * 0.5, 1)
                    .when(F.col("id") < n_orders * 0.8, 2).otherwise(3))
        .withColumn("last_snapshot", F.when(F.col("repeats") & (F.col("id") % 4 == 1), F.greatest("first_snapshot", F.lit(2))).otherwise(3))
    )
    if snapshot is not None:
        base = base.filter(F.lit(snapshot).between(F.col("first_snapshot"), F.col("last_snapshot")))
    narrow = (
        base.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(part.select("p_partkey", "p_name"), F.col("part_no") == F.col("p_partkey"))
        .withColumns({"chunk": F.col("id") % 7, "row_no": F.col("id")})
    )
    # Spread while rows are narrow and there is one of an id, into tasks of a bounded number of them: neither
    # the newest-row-per-id step nor the order of a dump then shuffles texts.
    cores = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    tasks = max(cores, orders.count() // IDS_PER_TASK + 1)
    spread = narrow.repartition(tasks, "id") if snapshot is None else narrow.repartitionByRange(tasks, "chunk", "row_no")
    joined = spread.join(items.withColumnRenamed("text", "blurb"), F.col("item_no") == F.col("item_id"))
    if snapshot is None:
        joined = joined.withColumn("snapshot", F.explode(F.sequence("first_snapshot", "last_snapshot")))
    else:
        joined = joined.withColumn("snapshot", F.lit(snapshot))
    state = (F.when(F.col("o_orderstatus") == "F", "successful")
             .when(F.col("o_orderstatus") == "O", "failed").otherwise("live"))
    slug = F.concat(F.col("c_mktsegment"), F.lit("-"), F.col("o_orderpriority"), F.lit('","slug":"'),
                    F.col("c_mktsegment"), F.lit("/"), F.col("o_orderpriority"))
    category = (F.when(_every(73), "{bad").when(_every(71), F.lit(None)).when(_every(74), "{'name':'single'}").when(_every(75), '{"name":"x"} more')
                .otherwise(F.concat(F.lit('{"name":"'), slug, F.lit('"}'))))
    location = F.when(_every(67), "[1]").otherwise(
        F.concat(F.lit('{"name":"'), F.col("c_name"), F.lit('","type":"'), F.col("o_orderpriority"), F.lit('"}')))
    return (
        joined.select(
            "id",
            F.col("p_name").alias("name"),
            "blurb",
            F.when(_every(97), "bad").when(_every(89), "0").otherwise(F.col("o_totalprice").cast("string")).alias("goal"),
            F.when((F.col("snapshot") < 3) & _every(5), "live").otherwise(state).alias("state"),
            F.when(~_every(79), F.col("n_name")).alias("country"),
            F.col("r_name").alias("currency"),
            F.when(_every(103), "1e30").otherwise((F.col("launch") + F.col("days") * DAY).cast("string")).alias("deadline"),
            (F.col("launch") - (1 + F.col("id") % 40) * DAY).cast("string").alias("created_at"),
            F.when(_every(101), "inf").otherwise(F.col("launch").cast("string")).alias("launched_at"),
            F.when(~_every(83), F.concat(F.lit("1."), F.col("r_regionkey"))).alias("static_usd_rate"),
            category.alias("category"),
            location.alias("location"),
            "snapshot",
            "chunk",
            "row_no",
        )
    )


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(campaigns_raw(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents. The given table is one file, read by one task, so its rows are dealt out by id."""
    found = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang", "source")
    return found.repartition("id")


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents: text with a 0/1 label."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("y"))
    return documents(spark, sf_dir).join(labels, "id")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-predictions of several models for every finished order: (model, id, y, score, pred)."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("F", "O"))
    rows = orders.select(F.col("o_orderkey").alias("id"),
                         (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    named = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(c).alias("right"))
                      for m, c in PSEUDO_MODELS.items()])
    key = F.concat(F.col("model"), F.lit("/"), F.col("id").cast("string"))
    return (
        rows.select("id", "y", F.explode(named).alias("m")).select("id", "y", "m.*")
        .withColumn("pred", F.when(key_hash(key, 1) % 100 < F.col("right"), F.col("y")).otherwise(1 - F.col("y")))
        .withColumn("score", (F.col("pred") * 0.4 + (key_hash(key, 2) % 1000) / F.lit(1000.0) * 0.6))
        .select("model", "id", "y", "score", "pred")
    )
