"""Session helpers: the shared folder and tables written to it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "launchcohort",
                  memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "localhost")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below the one the cluster names in `spark.checkpoint.dir`.

    Only a local session may go without that setting; it then gets a fresh temporary folder.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get(CHECKPOINT_KEY, None)
        if not named and not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="launchcohort-"))
    return context.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/launchcohort/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a parquet table in the shared folder.

    For results that several later steps read: it cuts the lineage, survives lost executors, and
    its file sizes give the planner true statistics for its join choices.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
