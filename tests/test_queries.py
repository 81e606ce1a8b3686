"""Every query with an SQL form gives the same result as DuckDB; plans stay free of cross joins."""

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries
from launchcohort.catalog import tables as T
from launchcohort.operators import cohort, encoders, reporting, significance, splits, text

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_names():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_as_sql(spark, duck, name):
    verdict, _, note = compare.check(spark, duck, name, SF, oracle_sql()[name])
    assert verdict == "ok", note


def test_no_cross_joins_and_no_single_task_windows(spark):
    raw = T.campaigns_raw(spark, SF)
    clean = cohort.clean(raw)
    docs = T.documents(spark, SF)
    plans = [clean, cohort.funnel(raw), reporting.rate_by_parent(clean), encoders.modal_parent(clean),
             encoders.level_means(clean, "location", "y"), encoders.level_sums(splits.with_fold(clean)), text.vocabulary(docs),
             text.term_counts(docs), significance.pair_cells(T.predictions(spark, SF), [("Logistic", "Chance")])]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        lines = plan.split("\n")
        for i, line in enumerate(lines):
            if "Window [" in line:
                assert "SinglePartition" not in "".join(lines[i:i + 4])


def test_level_sums_shuffle_levels_not_rows(spark):
    folded = splits.with_fold(T.campaigns(spark, SF))
    plan = encoders.level_sums(folded)._jdf.queryExecution().executedPlan().toString()
    last = plan.split("Exchange hashpartitioning(column")[1]
    assert "partial_count" in last.split("Generate")[0]
