"""Times the headline jobs and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import time

from launchcohort.catalog import queries as Q
from launchcohort.catalog import tables as T
from launchcohort.operators import models
from launchcohort.plans import experiment, features
from launchcohort.session import local_session, written

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Read, clean and describe; encode; text; metrics and paired tests: from the given tables each time.
QUERIES = [
    "a3_rate_by_parent", "d1_latest_per_id", "a1_cohort_funnel", "a2_cohort_profile", "a4_rate_by_goal_decile", "k1_random_split",
    "w1_temporal_split", "e3_out_of_fold_encoding", "t2_vocabulary", "t4_tfidf", "t6_out_of_fold_naive_bayes",
    "t9_sentiment", "w2_model_table", "g3_compare", "s4_snapshot_union",
]


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS))
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, job):
        start = time.time()
        out = job()
        seconds[name] = round(time.time() - start, 3)
        return out

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    Q.QUERIES["a10_confusion"](spark, SF_DIR).count()  # starts the workers
    cohort = timed("load_and_clean", lambda: written(T.campaigns(spark, SF_DIR), "cohort"))
    Q.cohort_table(spark, SF_DIR)
    for name in QUERIES:
        timed(name, lambda: drain(Q.QUERIES[name](spark, SF_DIR)))

    prepared = timed("split_and_features", lambda: experiment.prepare(cohort, features.FeatureBuilder()))
    train, test, columns = timed("assemble", lambda: prepared.sample(["meta", "nb"]))
    train, test = written(train, "train"), written(test, "test")
    n = train.count()
    for name, estimator in Q.SMALL_ZOO.estimators(n, len(columns)).items():
        def fit_and_score():
            drain(models.score(models.fit_model(estimator, train), test, name))

        timed(f"model_{name.lower().replace('. ', '_').replace(' ', '_')}", fit_and_score)
    print(json.dumps({
        "metric": "total seconds of the headline jobs", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": SF_DIR.rstrip("/").split("sf")[-1], "train_rows": n, "features": len(columns),
    }), flush=True)


if __name__ == "__main__":
    main()
