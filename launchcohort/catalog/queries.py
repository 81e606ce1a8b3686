"""One named query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchcohort.catalog import tables as T
from launchcohort.catalog.archives import write_archives
from launchcohort.functions import scalars as S
from launchcohort.functions.text import tokens
from launchcohort.operators import (
    cohort, contributions, encoders, lookup, metrics, models, reporting, scenarios, significance, splits, text, topics,
)
from launchcohort.operators.models import BEST, Boosting, Zoo
from launchcohort.plans import experiment, features
from launchcohort.session import shared_path, written
from launchcohort.sources import audit, sinks, snapshots, synthetic
from launchcohort.sources.cache import fingerprint_of, load_dataset

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Settings of the queries below.
LEXICON = {"the": 0.4, "and": 1.1, "der": -0.7, "ist": 1.5, "les": -1.3, "une": 0.9, "worthless": -2.1,
           "nicht": -0.8, "est": 1.2, "was": -0.6, "lorem": 0.3, "is": 0.5}
BOOSTERS = {"of": 0.293, "die": 0.293, "le": 0.293, "in": -0.293, "des": -0.293}
NEGATORS = ("with", "to", "zu", "un", "not")
LINEAR = {"m_log_goal": -0.5, "m_duration_days": -0.02, "m_launch_month": 0.03, "m_launch_dow": -0.02,
          "m_blurb_len": 0.004, "m_name_len": 0.01, "m_blurb_words": 0.05, "m_name_words": -0.08}
SMALL_ZOO = Zoo(Boosting(trees=10, depth=5, bins=64), forest_trees=20, forest_depth=10)
MODEL_PAIRS = [(BEST, m) for m in T.PSEUDO_MODELS if m != BEST] + [("Logistic", "Chance")]


def query(name: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return add


def per_session(make):
    """Builds a result once per session and data folder; all of them are written tables or models."""
    made = cache(lambda app, sf_dir, spark: make(spark, sf_dir))
    return lambda spark, sf_dir: made(spark.sparkContext.applicationId, sf_dir, spark)


def r6(column: str):
    return F.round(F.col(column), 6).alias(column)


# ---------------------------------------------------------------- shared inputs
@per_session
def cohort_table(spark, sf_dir) -> DataFrame:
    return written(T.campaigns(spark, sf_dir), "cohort")


@per_session
def dump(spark, sf_dir) -> str:
    """The raw rows as three csv snapshots, gzipped; a part file holds a bounded number of rows."""
    folder = shared_path(spark, "dump")
    for i in (1, 2, 3):
        synthetic.write_csv_snapshot(T.campaigns_raw(spark, sf_dir, i), f"{folder}/snapshot_{i:03d}", ("chunk", "row_no"), "gzip")
    return folder


@per_session
def lexicon(spark, sf_dir) -> DataFrame:
    return written(spark.createDataFrame(list(LEXICON.items()), "term string, valence double"), "lexicon")


@per_session
def prepared(spark, sf_dir) -> experiment.Prepared:
    builder = features.FeatureBuilder(lexicon=lexicon(spark, sf_dir))
    return experiment.prepare(cohort_table(spark, sf_dir), builder, ("meta", "nb", "sent", "lda", "lsa"))


@per_session
def final(spark, sf_dir) -> experiment.Final:
    return experiment.final_model(prepared(spark, sf_dir), Boosting())


# ---------------------------------------------------------------- sources and sinks
@query("s1_csv_scan")
def s1(spark, sf_dir):
    files = snapshots.list_files(spark, dump(spark, sf_dir))
    return snapshots.read_csv(spark, files).select(*snapshots.USED_COLUMNS)


@query("s2_archive_scan")
def s2(spark, sf_dir):
    raw = T.campaigns_raw(spark, sf_dir)
    archives = written(write_archives(raw, shared_path(spark, "archives")), "archive-list")
    return snapshots.read_archives(spark, archives.filter("members > 0")).select(*snapshots.USED_COLUMNS)


@query("s3_file_listing")
def s3(spark, sf_dir):
    files = snapshots.list_files(spark, dump(spark, sf_dir))
    return files.select(F.regexp_extract("path", r"(snapshot_\d+)", 1).alias("folder")).distinct()


@query("s4_snapshot_union")
def s4(spark, sf_dir):
    rows = snapshots.read_snapshots(spark, dump(spark, sf_dir))
    folder = F.regexp_extract("snapshot", r"(snapshot_\d+)", 1)
    return rows.groupBy(folder.alias("folder")).agg(
        F.count("*").alias("n_rows_read"), F.count_if(F.col("state") == "live").alias("n_live"))


@query("s5_audit_verdicts")
def s5(spark, sf_dir):
    orders, lineitem = T.table(spark, sf_dir, "orders"), T.table(spark, sf_dir, "lineitem")
    facts = orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("stamp")).agg(
        (F.count("*") / F.lit(7.0)).alias("mb"), F.count_distinct(F.day("o_orderdate")).alias("chunks"),
        (F.max("o_custkey") % 9 > 0).alias("valid_zip"))
    manifest = lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("stamp")).agg(
        F.count_distinct(F.day("l_shipdate")).alias("expected_chunks"), (F.count("*") / F.lit(28.0)).alias("expected_mb"))
    return audit.verdicts(manifest, facts).select("stamp", "ok", "reason")


@query("s6_fingerprint")
def s6(spark, sf_dir):
    month = F.date_format("o_orderdate", "yyyy-MM")
    listing = T.table(spark, sf_dir, "orders").groupBy(month.alias("month")).agg(F.count("*").alias("length"))
    files = listing.select(F.concat(F.lit("raw/"), F.substring("month", 1, 4), F.lit("/dump_"), "month", F.lit(".zip")).alias("path"), "length")
    return fingerprint_of(files, S.epoch_of(T.LAUNCH_FROM), None)


@query("s7_cached_table")
def s7(spark, sf_dir):
    folder = shared_path(spark, "cache")
    load_dataset(spark, dump(spark, sf_dir), cache=folder)
    table, stats = load_dataset(spark, dump(spark, sf_dir), cache=folder)
    return table.agg(
        F.count("*").alias("n"), F.sum("y").alias("y"), F.sum("launched_at").alias("launched_at"),
        F.count_distinct("location").alias("locations"),
    ).withColumns({c: stats.select(c).scalar() for c in ("n_rows_read", "n_unique_ids", "n_finished", "n_final")})


@query("s9_cumulative_snapshots")
def s9(spark, sf_dir):
    orders = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return synthetic.cumulative(orders, orders.count(), first_id=0).groupBy("snapshot").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query("s10_result_sinks")
def s10(spark, sf_dir):
    folder = shared_path(spark, "results")
    table = metrics.class_metrics(T.predictions(spark, sf_dir)).select("model", r6("A"), r6("F1"))
    sinks.write_results({"models": table}, folder)
    schema = "model string, A double, F1 double"
    as_csv = spark.read.csv(f"{folder}/models_csv", header=True, schema=schema)
    as_json = spark.read.json(f"{folder}/models_json", schema=schema)
    return as_csv.join(as_json.withColumnRenamed("F1", "F1_json").drop("A"), "model")


@query("s11_saved_bundle")
def s11(spark, sf_dir):
    """Saves features and classifier, loads both, and holds their scores of the test rows against those in memory."""
    done, folder = final(spark, sf_dir), shared_path(spark, "bundle")
    experiment.save_bundle(folder, prepared(spark, sf_dir).features, done)
    _, test = splits.split_data(cohort_table(spark, sf_dir))
    again = experiment.load_bundle(spark, folder).score(test).select("id", F.col("score").alias("again"), F.col("pred").alias("pred_again"))
    same = (F.abs(F.col("again") - F.col("score")) < 1e-9) & (F.col("pred") == F.col("pred_again"))
    return done.predictions.join(again, "id", "left").select("id", "y", F.coalesce(same, F.lit(False)).alias("same_score"))


# ---------------------------------------------------------------- projections
@query("p1_json_fields")
def p1(spark, sf_dir):
    return T.campaigns_raw(spark, sf_dir).select(
        "id", "snapshot", S.json_field(F.col("category"), "slug").alias("slug"),
        S.json_field(F.col("category"), "name").alias("category_name"),
        S.json_field(F.col("location"), "name").alias("location_name"),
        S.json_field(F.col("location"), "type").alias("location_type"))


@query("p2_parent_category")
def p2(spark, sf_dir):
    return T.campaigns_raw(spark, sf_dir).select(
        "id", "snapshot", S.parent_of_slug(S.json_field(F.col("category"), "slug")).alias("parent_category"))


@query("p3_numeric_cast")
def p3(spark, sf_dir):
    forms = F.array(F.col("goal"), F.concat("goal", F.lit("d")), F.concat(F.lit(" "), "goal", F.lit(" ")),
                    F.concat(F.lit("-"), "goal"), F.lit("NaN"), F.concat("goal", F.lit("e1")), F.col("name"))
    return T.campaigns_raw(spark, sf_dir).select(
        "id", "snapshot", S.to_number(F.get(forms, (F.col("id") % 7).cast("int"))).alias("number"),
        S.to_number(F.col("launched_at")).alias("launched_at"))


@query("p4_goal_usd")
def p4(spark, sf_dir):
    raw = T.campaigns_raw(spark, sf_dir)
    return cohort.normalised(raw).select("id", "snapshot", r6("goal_usd"), r6("usd_rate"))


@query("p5_null_defaults")
def p5(spark, sf_dir):
    return cohort.normalised(T.campaigns_raw(spark, sf_dir)).select("id", "snapshot", "name", "country", "currency")


@query("p6_label")
def p6(spark, sf_dir):
    return T.campaigns_raw(spark, sf_dir).select("id", "snapshot", "state", F.coalesce(S.label(F.col("state")), F.lit(-1)).alias("y"))


@query("p7_log_goal")
def p7(spark, sf_dir):
    return T.campaigns(spark, sf_dir).select("id", F.round(S.log_goal(F.col("goal_usd")), 6).alias("m_log_goal"))


@query("p8_duration_days")
def p8(spark, sf_dir):
    return T.campaigns(spark, sf_dir).withColumns(features.static_columns()).select("id", "m_duration_days")


@query("p9_launch_parts")
def p9(spark, sf_dir):
    return T.campaigns(spark, sf_dir).withColumns(features.static_columns()).select("id", "m_launch_month", "m_launch_dow")


@query("p10_text_sizes")
def p10(spark, sf_dir):
    docs = T.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("blurb"))
    return docs.select("id", F.length("blurb").alias("m_blurb_len"), S.word_count(F.col("blurb")).alias("m_blurb_words"))


@query("p11_one_hot")
def p11(spark, sf_dir):
    df = cohort_table(spark, sf_dir)
    hot = encoders.onehot_columns(encoders.fit_onehots(df))
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), c.alias("value")) for n, c in hot.items()])
    return df.select("id", F.inline(pairs)).groupBy("feature").agg(
        F.sum("value").cast("bigint").alias("ones"), F.sum(F.col("value") * F.col("id")).cast("bigint").alias("id_sum"))


@query("p12_sentences")
def p12(spark, sf_dir):
    parts = S.sentences(F.col("text"))
    return T.documents(spark, sf_dir).select(
        "id", F.size(parts).alias("n_sentences"), F.md5(F.array_join(parts, "|")).alias("sentences_md5"))


@query("p13_feature_blocks")
def p13(spark, sf_dir):
    """Rows without a missing value, and columns, of each feature sample of the test rows."""
    p, out = prepared(spark, sf_dir), None
    for name, blocks in features.SAMPLES.items():
        columns = p.features.columns_for(blocks)
        part = p.test.select(*columns).dropna().agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("sample"), F.lit(len(columns)).alias("n_features"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


@query("p14_iso_epoch")
def p14(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), S.epoch_of_date(day).alias("epoch"))


@query("p15_verdict")
def p15(spark, sf_dir):
    return T.predictions(spark, sf_dir).select(
        "model", "id", S.verdict(F.col("score")).alias("verdict"), S.band(F.col("score")).alias("band"))


# ---------------------------------------------------------------- filters, repeats
def _latest(spark, sf_dir):
    return cohort.latest_per_id(T.campaigns_raw(spark, sf_dir))


@query("f1_finished_only")
def f1(spark, sf_dir):
    return cohort.finished(_latest(spark, sf_dir)).select("id", "state", "y")


@query("f2_required_fields")
def f2(spark, sf_dir):
    return cohort.complete(cohort.normalised(_latest(spark, sf_dir))).select("id", "launched_at", "deadline")


@query("f3_valid_rows")
def f3(spark, sf_dir):
    return cohort.normalised(_latest(spark, sf_dir)).filter(cohort.is_valid()).select("id", "launched_at", "deadline")


@query("f4_launch_window")
def f4(spark, sf_dir):
    inside = cohort.in_window(S.epoch_of(T.LAUNCH_FROM), S.epoch_of(T.LAUNCH_TO))
    return T.campaigns(spark, sf_dir).filter(inside).select("id", "launched_at", "y")


@query("f5_no_banned_columns")
def f5(spark, sf_dir):
    kept = cohort.without_banned(_latest(spark, sf_dir))
    assert not cohort.banned_in(kept)
    return kept.drop("row_no", "chunk")


@query("f6_table_guards")
def f6(spark, sf_dir):
    raw = cohort.normalised(T.campaigns_raw(spark, sf_dir)).withColumn("y", S.label(F.col("state")))
    return metrics.violations(raw, ["goal_usd", "launched_at", "deadline"])


@query("d1_latest_per_id")
def d1(spark, sf_dir):
    return _latest(spark, sf_dir).select("id", "snapshot", "state", "name", "blurb", "goal")


@query("d2_repeats_dropped")
def d2(spark, sf_dir):
    return T.campaigns(spark, sf_dir).select("id", "name", "launched_at", "deadline", "y")


# ---------------------------------------------------------------- joins
@query("j1_level_lookup")
def j1(spark, sf_dir):
    """Every campaign against the location means of the finished half of the launches."""
    df = cohort_table(spark, sf_dir)
    early = df.filter(F.col("launched_at") < S.epoch_of("1998-01-01"))
    means = written(encoders.level_means(early, "location", "y"), "location-means")
    prior = early.agg(F.avg("y")).scalar()
    found = lookup.lookup(df, means.withColumnRenamed("level", "location"), "location", rows_of="n")
    return found.select("id", F.round(F.coalesce("mean", prior), 6).alias("location_mean"))


@query("j2_parent_and_rate")
def j2(spark, sf_dir):
    df = cohort_table(spark, sf_dir)
    early = df.filter(F.col("launched_at") < S.epoch_of("1998-01-01"))
    parent, rate = written(encoders.modal_parent(early), "parents"), written(encoders.median_rate(early), "rates")
    return scenarios.with_known_values(df.select("id", "category", "currency"), parent, rate).select(
        "id", "parent_category", r6("usd_rate"))


@query("j3_paired_correctness")
def j3(spark, sf_dir):
    return significance.pair_cells(T.predictions(spark, sf_dir), MODEL_PAIRS)


@query("j4_goal_ladder")
def j4(spark, sf_dir):
    rungs = scenarios.ladder(cohort_table(spark, sf_dir).select("id", "goal_usd"))
    return rungs.select("id", "base_id", "rung", "multiplier", r6("goal_usd"))


# ---------------------------------------------------------------- aggregations
@query("a1_cohort_funnel")
def a1(spark, sf_dir):
    return cohort.funnel(T.campaigns_raw(spark, sf_dir), S.epoch_of(T.LAUNCH_FROM), S.epoch_of(T.LAUNCH_TO))


@query("a2_cohort_profile")
def a2(spark, sf_dir):
    bounds = S.epoch_of(T.LAUNCH_FROM), None
    df = T.campaigns(spark, sf_dir).filter(cohort.in_window(*bounds))
    return cohort.profile(df, *bounds).withColumns({
        c: F.round(c, 6) for c in ("success_rate", "goal_usd_median")})


@query("a3_rate_by_parent")
def a3(spark, sf_dir):
    return reporting.rate_by_parent(T.campaigns(spark, sf_dir)).withColumn("mean", F.round("mean", 6))


@query("a4_rate_by_goal_decile")
def a4(spark, sf_dir):
    found = reporting.rate_by_goal(cohort_table(spark, sf_dir))
    return found.select("bin", "n", r6("rate"), r6("goal"))


@query("a5_level_counts")
def a5(spark, sf_dir):
    return encoders.level_counts(T.campaigns(spark, sf_dir), ["parent_category", "category"])


@query("a6_modal_parent")
def a6(spark, sf_dir):
    return encoders.modal_parent(T.campaigns(spark, sf_dir))


@query("a7_median_rate")
def a7(spark, sf_dir):
    return encoders.median_rate(T.campaigns(spark, sf_dir)).select("currency", r6("usd_rate"))


@query("a8_distinct_levels")
def a8(spark, sf_dir):
    return encoders.distinct_levels(T.campaigns(spark, sf_dir))


@query("a9_split_summary")
def a9(spark, sf_dir):
    found = splits.split_summary(splits.with_split(cohort_table(spark, sf_dir)))
    return found.select("n_train", "n_test", r6("train_success_rate"), r6("test_success_rate"), r6("baseline_acc"))


@query("a10_confusion")
def a10(spark, sf_dir):
    return metrics.confusion(T.predictions(spark, sf_dir))


@query("a11_class_metrics")
def a11(spark, sf_dir):
    found = metrics.class_metrics(T.predictions(spark, sf_dir))
    return found.select("model", *[r6(c) for c in metrics.METRICS if c != "AUC"])


@query("a12_auc")
def a12(spark, sf_dir):
    return metrics.auc(T.predictions(spark, sf_dir)).select("model", r6("AUC"))


def _runs(spark, sf_dir):
    """Accuracy of each pseudo-model on five parts of its rows, in the place of five seeds."""
    parts = T.predictions(spark, sf_dir).withColumn("seed", splits.fold_of(F.col("id"), 5, 7))
    found = metrics.class_metrics(parts, ("model", "seed"))
    return found.select(F.col("model").alias("sample"), "seed", F.length("model").alias("n_features"), "A", "F1")


@query("a13_ablation_summary")
def a13(spark, sf_dir):
    found = reporting.ablation_summary(_runs(spark, sf_dir))
    # The lists in millionths, joined.
    lists = [F.array_join(F.transform(c, lambda v: F.round(v * 1e6).cast("bigint").cast("string")), ",").alias(c) for c in ("accs", "f1s")]
    return found.select("sample", "n_features", "n_runs", *[r6(c) for c in ("acc_mean", "acc_std", "f1_mean", "f1_std")], *lists)


@query("a14_report_deltas")
def a14(spark, sf_dir):
    summary = written(reporting.ablation_summary(_runs(spark, sf_dir)), "summary")
    found = reporting.sample_deltas(summary, "Logistic", "R. Forest")
    return found.select("sample", r6("acc_mean"), r6("vs_first"), r6("vs_second"))


@query("a14_headline")
def a14_headline(spark, sf_dir):
    preds = T.predictions(spark, sf_dir)
    rate = preds.agg(F.avg("y").alias("p")).first()["p"]
    found = reporting.headline(metrics.class_metrics(preds), max(rate, 1 - rate))
    return found.select("model", "n_models", *[r6(c) for c in (
        "A", "R0", "R1", "over_baseline", "over_second", "over_fourth")])


@query("a15_significance_digest")
def a15(spark, sf_dir):
    cells = significance.with_mcnemar(significance.pair_cells(T.predictions(spark, sf_dir), MODEL_PAIRS))
    tests = cells.select("A", "B", ((F.col("a_only") - F.col("b_only")) / F.col("n")).alias("acc_diff"), "mcnemar_p",
                         (F.col("mcnemar_p") < 0.05).alias("significant_95"))
    found = reporting.significance_digest(tests, BEST)
    return found.select("kind", "n", "significant", "not_significant", r6("lead_min"), r6("lead_max"), r6("p_max"),
                        "all_significant")


# ---------------------------------------------------------------- order, splits
@query("w1_temporal_split")
def w1(spark, sf_dir):
    return splits.with_split(cohort_table(spark, sf_dir), "temporal").select("id", "launched_at", "split")


@query("w2_model_table")
def w2(spark, sf_dir):
    return metrics.model_table(T.predictions(spark, sf_dir)).select("model", *[r6(c) for c in metrics.METRICS])


@query("w3_top_levels")
def w3(spark, sf_dir):
    counts = encoders.level_counts(T.campaigns(spark, sf_dir), encoders.CAT_COLS, 1)
    return metrics.top(counts, "n", 15, "column", "level")


@query("w3_top_contributions")
def w3_contributions(spark, sf_dir):
    df = cohort_table(spark, sf_dir).withColumns(features.static_columns())
    means = df.agg(*[F.avg(c).alias(c) for c in LINEAR]).first().asDict()
    found = contributions.linear_contributions(df, LINEAR, means)
    return contributions.top_contributions(found, list(LINEAR), 5).select(
        "id", "place", "feature", r6("contribution"))


@query("k1_random_split")
def k1(spark, sf_dir):
    return splits.with_split(cohort_table(spark, sf_dir)).select("id", "y", "split")


@query("k2_folds")
def k2(spark, sf_dir):
    return splits.with_fold(T.campaigns(spark, sf_dir)).select("id", "fold")


@query("k3_sample")
def k3(spark, sf_dir):
    return splits.sample_rows(cohort_table(spark, sf_dir), 4000).select("id", "y")


# ---------------------------------------------------------------- encodings
@query("e1_smoothed_means")
def e1(spark, sf_dir):
    found = encoders.level_means(T.campaigns(spark, sf_dir), "location", "y")
    return found.select("level", "n", r6("mean"))


@query("e2_encode_new_rows")
def e2(spark, sf_dir):
    """Means fitted on the training part, put on the test part."""
    train, test = splits.split_data(cohort_table(spark, sf_dir), "temporal")
    fitted = encoders.fit_levels(splits.with_fold(train))
    return fitted.encode(test).select("id", *[r6(f"m_te_{c}") for c in encoders.CAT_COLS])


@query("e3_out_of_fold_encoding")
def e3(spark, sf_dir):
    folded = splits.with_fold(cohort_table(spark, sf_dir))
    fitted = encoders.fit_levels(folded)
    return fitted.encode(folded, out_of_fold=True).select("id", *[r6(f"m_te_{c}") for c in encoders.CAT_COLS])


def _goal_columns(spark, sf_dir, prefix):
    folded = splits.with_fold(cohort_table(spark, sf_dir))
    return encoders.fit_levels(folded).encode(folded).select("id", *[r6(f"{prefix}{c}") for c in encoders.CAT_COLS])


@query("e4_goal_means")
def e4(spark, sf_dir):
    return _goal_columns(spark, sf_dir, "m_goalmean_")


@query("e5_goal_differences")
def e5(spark, sf_dir):
    return _goal_columns(spark, sf_dir, "m_goaldiff_")


# ---------------------------------------------------------------- text
@query("t1_tokens")
def t1(spark, sf_dir):
    found = T.documents(spark, sf_dir).select("id", tokens(F.col("text")).alias("tokens"))
    return found.select("id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query("t2_vocabulary")
def t2(spark, sf_dir):
    return text.vocabulary(T.documents(spark, sf_dir))


@query("t3_term_counts")
def t3(spark, sf_dir):
    return text.term_counts(T.documents(spark, sf_dir))


@query("t4_tfidf")
def t4(spark, sf_dir):
    docs = T.documents(spark, sf_dir)
    terms, _ = text.fit_vocabulary(docs)
    return text.weights(text.term_counts(docs), terms).select("id", "term", r6("w"))


@per_session
def text_model(spark, sf_dir) -> text.TextModel:
    return text.fit_text(splits.with_fold(T.doc_labels(spark, sf_dir)))


@query("t5_naive_bayes")
def t5(spark, sf_dir):
    """Fitted on the labelled documents, put on all documents."""
    return text_model(spark, sf_dir).nb_probability(T.documents(spark, sf_dir)).select("id", r6("nb_prob"))


@query("t6_out_of_fold_naive_bayes")
def t6(spark, sf_dir):
    folded = splits.with_fold(T.doc_labels(spark, sf_dir))
    return text_model(spark, sf_dir).out_of_fold_probability(folded).select("id", r6("nb_prob"))


@query("t7_lsa")
def t7(spark, sf_dir):
    docs = T.documents(spark, sf_dir)
    terms, _ = text.fit_vocabulary(docs)
    tfidf = written(text.weights(text.term_counts(docs), terms), "tfidf")
    model = topics.fit_lsa(tfidf, terms)
    return model.project(tfidf, docs)


@query("t8_lda")
def t8(spark, sf_dir):
    docs = T.documents(spark, sf_dir)
    return topics.fit_lda(docs).mix(docs)


@query("t9_sentiment")
def t9(spark, sf_dir):
    found = text.sentiment(T.documents(spark, sf_dir), lexicon(spark, sf_dir), boosters=BOOSTERS, negators=NEGATORS)
    return found.select("id", *[F.round(c, 4).alias(c) for c in ("sent_compound", "sent_mean_sentence")])


# ---------------------------------------------------------------- models
def _predictions(spark, sf_dir, names):
    return experiment.predict_all(prepared(spark, sf_dir), ["meta", "nb"], SMALL_ZOO, only=names)[0]


@query("m1_boosting")
def m1(spark, sf_dir):
    return final(spark, sf_dir).predictions


@query("m2_forest")
def m2(spark, sf_dir):
    return _predictions(spark, sf_dir, ["R. Forest"])


@query("m3_neural_net")
def m3(spark, sf_dir):
    return _predictions(spark, sf_dir, ["Neural Net"])


@query("m4_linear_svm")
def m4(spark, sf_dir):
    return _predictions(spark, sf_dir, ["SVM"])


@query("m5_logistic")
def m5(spark, sf_dir):
    return _predictions(spark, sf_dir, ["Logistic"])


@query("m6_linear_probability")
def m6(spark, sf_dir):
    return _predictions(spark, sf_dir, ["Ridge", "OLS", "Lasso"])


@query("m6_least_squares_line")
def m6_line(spark, sf_dir):
    """Least squares of the label on one feature, whose answer is known in closed form."""
    df = cohort_table(spark, sf_dir).withColumns(features.static_columns())
    line = LinearRegression(labelCol="y", featuresCol="features").fit(models.assembled(df, ["m_log_goal"]))
    return spark.createDataFrame([(float(line.coefficients[0]), float(line.intercept))], "slope double, intercept double").select(
        r6("slope"), r6("intercept"))


@query("m7_class_weights")
def m7(spark, sf_dir):
    return models.class_weights(T.campaigns(spark, sf_dir)).select("y", r6("weight"))


@query("m8_scaler_moments")
def m8(spark, sf_dir):
    df = cohort_table(spark, sf_dir).withColumns(features.static_columns())
    return models.scaler_moments(df, list(LINEAR)).select("feature", r6("mean"), r6("std"))


@query("m9_model_comparison")
def m9(spark, sf_dir):
    return experiment.run_model_table(prepared(spark, sf_dir), ["meta", "nb"], Zoo())


@query("m10_text_ablation")
def m10(spark, sf_dir):
    return experiment.run_ablation(prepared(spark, sf_dir), Boosting())[1]


@query("m11_random_search")
def m11(spark, sf_dir):
    p = prepared(spark, sf_dir)
    train = models.assembled(p.train, p.features.columns_for(["meta", "nb"]))
    return models.search_boosting(train)[1]


@query("m12_final_model")
def m12(spark, sf_dir):
    done = final(spark, sf_dir)
    return metrics.model_table(done.predictions).withColumn("test_accuracy", F.lit(done.accuracy))


@query("m13_importances")
def m13(spark, sf_dir):
    done = final(spark, sf_dir)
    return metrics.top(models.importances(done.model, done.columns, spark), "gain", 15, "feature")


# ---------------------------------------------------------------- paired tests
@query("g1_paired_bootstrap")
def g1(spark, sf_dir):
    cells = significance.pair_cells(T.predictions(spark, sf_dir), MODEL_PAIRS)
    return significance.with_interval(cells)


@query("g2_mcnemar")
def g2(spark, sf_dir):
    cells = significance.with_mcnemar(significance.pair_cells(T.predictions(spark, sf_dir), MODEL_PAIRS))
    return cells.select("A", "B", "a_only", "b_only", r6("mcnemar_p"))


@query("g3_compare")
def g3(spark, sf_dir):
    return significance.compare(T.predictions(spark, sf_dir), MODEL_PAIRS)


@query("g4_planned_comparisons")
def g4(spark, sf_dir):
    names = list(T.PSEUDO_MODELS)
    pairs = significance.planned_pairs(["Chance", "OLS", "R. Forest", "Logistic"], names, BEST)
    cells = significance.pair_cells(T.predictions(spark, sf_dir), pairs)
    return cells.select("A", "B", "n", F.round((F.col("a_only") - F.col("b_only")) / F.col("n"), 6).alias("acc_diff"))


@query("g4_study_comparisons")
def g4_study(spark, sf_dir):
    """The planned comparisons of the fitted feature samples and models."""
    return experiment.run_significance(prepared(spark, sf_dir), Zoo())


# ---------------------------------------------------------------- scenarios
def _scenarios(spark, sf_dir):
    """Each order as a plan: some without a location, in its customer's country and currency."""
    raw = cohort.normalised(_latest(spark, sf_dir)).filter(cohort.is_valid())
    rows = raw.select("id", "name", "blurb", "category", "country", "currency",
                      (F.col("goal_usd") / F.col("usd_rate")).alias("goal"),
                      S.launch_date(F.col("launched_at")).alias("launch"),
                      ((F.col("deadline") - F.col("launched_at")) / S.DAY).cast("int").alias("days"),
                      F.when(F.col("location") == S.UNKNOWN, " ").otherwise(F.col("location")).alias("location"),
                      "location_type")
    fitted = prepared(spark, sf_dir).features
    return scenarios.cohort_rows(rows, fitted.cat_parent, fitted.currency_rate)


def _scored(spark, sf_dir, rows, transform=features.FittedFeatures.transform):
    fitted, done = prepared(spark, sf_dir).features, final(spark, sf_dir)
    ready = models.assembled(transform(fitted, rows, ["meta", "nb"]), done.columns).withColumn("y", F.lit(None).cast("int"))
    return models.score(done.model, ready, BEST).select("id", F.col("score").alias("probability"))


@query("x1_scenario_scores")
def x1(spark, sf_dir):
    scored = _scored(spark, sf_dir, _scenarios(spark, sf_dir))
    return scored.withColumns({"verdict": S.verdict(F.col("probability")), "band": S.band(F.col("probability"))})


@query("x2_goal_sensitivity")
def x2(spark, sf_dir):
    rows = written(_scenarios(spark, sf_dir), "ladder-rows")
    scored = _scored(spark, sf_dir, rows, features.FittedFeatures.transform_ladder)
    return scenarios.ladder(rows.select("id", "goal_usd")).select("id", "base_id", "multiplier", "goal_usd").join(scored, "id").drop("id")


@query("x3_contributions")
def x3(spark, sf_dir):
    done = final(spark, sf_dir)
    explained = contributions.boosting_contributions(
        done.model, models.assembled(prepared(spark, sf_dir).test, done.columns), done.columns)
    return contributions.top_contributions(explained, done.columns)
