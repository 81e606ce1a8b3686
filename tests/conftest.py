import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from launchcohort.session import local_session, written  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def synthetic_dump(spark, tmp_path_factory):
    from launchcohort.sources.synthetic import make_synthetic, write_cumulative_dump

    folder = str(tmp_path_factory.mktemp("dump"))
    return write_cumulative_dump(make_synthetic(spark, 3000, seed=1), folder, 3000)


@pytest.fixture(scope="session")
def raw(spark, synthetic_dump):
    from launchcohort.sources.snapshots import read_snapshots

    return written(read_snapshots(spark, synthetic_dump), "raw")


@pytest.fixture(scope="session")
def cohort_df(raw):
    from launchcohort.operators.cohort import clean

    return written(clean(raw), "cohort")


@pytest.fixture(scope="session")
def prepared(spark, cohort_df):
    from launchcohort.plans.experiment import prepare
    from launchcohort.plans.features import FeatureBuilder

    words = written(spark.createDataFrame([("sunlit", 2.0), ("frosty", -1.5)],
                                          "term string, valence double"), "lexicon")
    builder = FeatureBuilder(lexicon=words, lda_topics=5, lda_passes=2, lsa_dims=6)
    return prepare(cohort_df, builder, ("meta", "nb", "sent", "lda", "lsa"))
