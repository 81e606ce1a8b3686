"""The corpus pipeline: toxic documents go, then lines that many documents share, near copies but one,
and copies of benchmark items; what is left is mixed to target weights.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns the columns of
`documents`, the last one what the mix takes of each document. Extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchcohort.llm import decontamination, line_dedup, minhash, mixing, toxicity
from launchcohort.llm.common import table
from launchcohort.session import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score `toxicity.THRESHOLD` or more; null and empty texts stay."""
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"), with_text=True)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines found in ten documents or more; a null text becomes an empty one, n_chars is the new length."""
    out = line_dedup.line_dedup(docs, min_docs=10)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one of the smallest doc_id; shingles of five words, similarity 0.8."""
    groups = minhash.near_duplicates(docs, words_per=5, similarity=80)
    copies = written(groups.where(~F.col("id").eqNullSafe(F.col("component_id"))).select("id", "mark").distinct(), "copies")
    return minhash.only(docs, copies, "left_anti")


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item, exact or edited."""
    found = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return minhash.only(docs, written(found.select("id", "mark").distinct(), "leaked"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document, and for which shard."""
    return mixing.mix(docs).select("row.doc_id", "row.source", "size", "source_size", "target", "taken", "shard")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaked),
    ("mixing", mix_sources),
]

# Fitted models and hash-made draws have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
