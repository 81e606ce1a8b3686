import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from launchcohort.operators import text, topics
from launchcohort.operators.splits import with_fold
from launchcohort.session import written

STOPS = ("the", "of")


@pytest.fixture(scope="module")
def docs(spark):
    """Texts of random words; some have none that count, and one word is in most of them."""
    words = [f"w{i}" for i in range(40)]
    rng = np.random.default_rng(7)
    rows = []
    for i in range(240):
        picked = [words[int(j)] for j in rng.zipf(1.6, 25) if j < 40]
        y = int(rng.random() < 0.3 + 0.4 * ("w5" in picked))
        rows.append((i, "" if i % 40 == 0 else "The " + " ".join(picked) + " of everywhere", y))
    return written(with_fold(spark.createDataFrame(rows, "id bigint, text string, y int")), "docs")


def dense(docs, min_df=5, max_df=0.6):
    """TF-IDF by hand."""
    pdf = docs.toPandas().sort_values("id", ignore_index=True)
    bags = [[w for w in t.lower().split() if w not in STOPS and len(w) > 1] for t in pdf["text"]]
    df = {}
    for b in bags:
        for w in set(b):
            df[w] = df.get(w, 0) + 1
    vocab = sorted(w for w, n in df.items() if min_df <= n <= max_df * len(pdf))
    x = np.zeros((len(pdf), len(vocab)))
    for i, b in enumerate(bags):
        for j, w in enumerate(vocab):
            tf = b.count(w)
            if tf:
                x[i, j] = (1 + np.log(tf)) * (np.log((1 + len(pdf)) / (1 + df[w])) + 1)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return pdf, vocab, x / np.where(norm == 0, 1, norm)


def bayes(x, y, new, alpha=1.0):
    logs, priors = [], []
    for c in (0, 1):
        s = x[y == c].sum(axis=0) + alpha
        logs.append(np.log(s / s.sum()))
        priors.append(np.log((y == c).mean()))
    joint = np.stack([new @ lp + p for lp, p in zip(logs, priors)], axis=1)
    e = np.exp(joint - joint.max(axis=1, keepdims=True))
    return (e / e.sum(axis=1, keepdims=True))[:, 1]


@pytest.fixture(scope="module")
def fitted(docs):
    return text.fit_text(docs, min_df=5, max_df=0.6, stop_words=STOPS)


def test_vocabulary_and_weights(docs, fitted):
    pdf, vocab, x = dense(docs)
    found = text.vocabulary(docs, min_df=5, max_df=0.6, stop_words=STOPS).toPandas()
    assert sorted(found["term"]) == vocab and "everywhere" not in vocab
    got = fitted.tfidf(docs).toPandas().pivot(index="id", columns="term", values="w").reindex(index=pdf["id"], columns=vocab).fillna(0)
    assert got.to_numpy() == pytest.approx(x, abs=1e-12)


def test_naive_bayes_for_new_rows(docs, fitted):
    pdf, _, x = dense(docs)
    got = fitted.nb_probability(docs).toPandas().sort_values("id")
    assert got["nb_prob"].to_numpy() == pytest.approx(bayes(x, pdf["y"].to_numpy(), x), abs=1e-12)


def test_out_of_fold_naive_bayes_equals_refitting(docs, fitted):
    pdf, _, x = dense(docs)
    y, fold = pdf["y"].to_numpy(), pdf["fold"].to_numpy()
    want = np.zeros(len(pdf))
    for f in range(5):
        want[fold == f] = bayes(x[fold != f], y[fold != f], x[fold == f])
    got = fitted.out_of_fold_probability(docs).toPandas().sort_values("id")
    assert got["nb_prob"].to_numpy() == pytest.approx(want, abs=1e-12)


def test_own_label_does_not_matter(docs, fitted):
    flipped = written(docs.withColumn("y", F.when(F.col("id") == 7, 1 - F.col("y")).otherwise(F.col("y"))), "flipped")
    other = text.fit_text(flipped, min_df=5, max_df=0.6, stop_words=STOPS)
    one, two = (m.out_of_fold_probability(d).filter("id = 7").first()["nb_prob"] for m, d in ((fitted, docs), (other, flipped)))
    assert one == pytest.approx(two, abs=1e-14)


def test_weights_beyond_broadcast(docs, fitted, monkeypatch):
    from launchcohort.operators import lookup

    want = fitted.nb_probability(docs).orderBy("id").collect()
    monkeypatch.setattr(text, "lookup", lambda *a, **k: lookup.lookup(*a, **k, limit=0))
    assert np.array(fitted.nb_probability(docs).orderBy("id").collect()) == pytest.approx(np.array(want), abs=1e-12)


def test_lsa_is_a_truncated_svd(docs, fitted):
    pdf, vocab, x = dense(docs)
    model = topics.fit_lsa(fitted.train, fitted.terms, dims=6)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    assert model.singular_values[:3] == pytest.approx(s[:3], rel=1e-3)
    assert model.singular_values == pytest.approx(s[:6], rel=2e-2)
    got = np.array(model.project(fitted.tfidf(docs), docs).orderBy("id").toPandas()["lsa"].tolist())
    for axis in range(3):
        assert abs(np.corrcoef(got[:, axis], u[:, axis])[0, 1]) > 0.99
    left_over = np.linalg.norm(x - u[:, :6] * s[:6] @ np.linalg.svd(x, full_matrices=False)[2][:6])
    assert np.sqrt((x ** 2).sum() - (got ** 2).sum()) == pytest.approx(left_over, rel=1e-2)
    assert not got[0].any()  # a text without terms


def test_topic_shares_sum_to_one(docs):
    got = np.array(topics.fit_lda(docs, topics=4, min_df=5, max_df=0.6).mix(docs).toPandas()["lda"].tolist())
    assert got.shape == (240, 4) and got[1].sum() == pytest.approx(1)
    assert got.sum(axis=1) == pytest.approx(np.ones(240))


def test_digamma():
    x = np.array([1e-3, 0.05, 0.5, 1.0, 3.7, 10.0, 4000.0])
    h = 1e-5
    assert topics.digamma(x)[1:] == pytest.approx(((lgamma(x + h) - lgamma(x - h)) / (2 * h))[1:], rel=1e-6)
    assert topics.digamma(x)[0] == pytest.approx(-1000.5755719318103)


lgamma = np.vectorize(math.lgamma)


def test_mini_batches_hold_every_text_once(docs, fitted):
    terms, size = topics.numbered(fitted.terms.select("term", "df"))
    rows = terms.orderBy("place").collect()
    assert [r.place for r in rows] == list(range(size)) and [r.term for r in rows] == sorted(r.term for r in rows)
    bags = topics.bags(docs, terms, fitted.text)
    stored, sizes = topics.dealt(bags, 5)
    assert sum(sizes) == bags.count() and min(sizes) > 0
    assert sorted(map(tuple, stored.drop("batch").collect())) == sorted(map(tuple, bags.collect()))
    # A step reads the files of its batch only.
    one = stored.where("batch = 3")
    assert "PartitionFilters: [isnotnull(batch" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == sizes[3] and one.select(F.input_file_name().alias("file")).distinct().count() == 1


def test_step_is_the_plain_update(docs, fitted):
    """The evidence of a batch against a loop over dense rows."""
    terms, size = topics.numbered(fitted.terms.select("term", "df"))
    bags = topics.bags(docs, terms, fitted.text)
    start = np.random.default_rng(0).gamma(100.0, 0.01, (3, size))
    beta, want = topics.mean_log(start), np.zeros((3, size))
    for r in bags.collect():
        x = np.zeros(size)
        x[r.places] = r.counts
        gamma, _ = topics.infer(x, beta, 1 / 3)
        theta = topics.mean_log(gamma)
        want += np.outer(theta, x / (theta @ beta + 1e-100)) * beta
    assert topics.evidence(bags, start) == pytest.approx(want, rel=1e-9, abs=1e-9)
    assert want.sum() == pytest.approx(sum(sum(r.counts) for r in bags.collect()))


def test_topics_find_two_vocabularies(spark):
    rng = np.random.default_rng(3)
    words = [[f"{a}{b}" for b in "bcdfghjk"] for a in ("sun", "ice")]
    texts = [(i, " ".join(rng.choice(words[i % 2], 30))) for i in range(200)] + [(900, None), (901, "")]
    df = spark.createDataFrame(texts, "id bigint, text string")
    model = topics.fit_lda(df, topics=2, passes=4, steps=4, min_df=2, max_df=1.0)
    got = {r.id: np.array(r.lda) for r in model.mix(df).collect()}
    assert len({int(got[i].argmax()) for i in range(0, 200, 2)}) == len({int(got[i].argmax()) for i in range(1, 200, 2)}) == 1
    assert got[0].argmax() != got[1].argmax() and all(g.max() > 0.9 for i, g in got.items() if i < 900)
    assert got[900].tolist() == got[901].tolist() == [0.5, 0.5]
    again = topics.fit_lda(df, topics=2, passes=4, steps=4, min_df=2, max_df=1.0)
    assert again.topics == pytest.approx(model.topics, rel=1e-9)
    assert topics.fit_lda(df.limit(0), topics=2).mix(df.limit(3)).count() == 3


def squash(v):
    return v / np.sqrt(v * v + 15)


@pytest.mark.parametrize("said,want", [
    ("good", squash(2.0)), ("", 0.0), ("plain words", 0.0), ("not good", squash(2.0 * -0.74)),
    ("very good", squash(2.293)), ("very, very good", squash(2.0 + 0.293 + 0.293 * 0.95)), ("really bad", squash(-2.793)),
    ("good!!", squash(2.0 + 2 * 0.292)), ("bad!!!!!!", squash(-2.5 - 4 * 0.292)), ("good ??", squash(2.36)), ("good ?????", squash(2.96)),
    ("good but bad", squash(1.0 - 3.75)), ("never so good", squash((2.0 + 0.293) * -0.74)), ("not a b c good", squash(2.0)),
])
def test_sentiment_of_a_text(spark, said, want):
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.5)], "term string, valence double")
    got = text.sentiment(spark.createDataFrame([(1, said)], "id bigint, text string"), lexicon).first()
    assert got["sent_compound"] == pytest.approx(want, abs=1e-12)
    assert got["sent_mean_sentence"] == pytest.approx(want, abs=1e-12)


def test_sentiment_by_sentence(spark):
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.5)], "term string, valence double")
    got = text.sentiment(spark.createDataFrame([(1, "It is not. Good! Nothing here? Bad.")], "id bigint, text string"), lexicon).first()
    assert got["sent_mean_sentence"] == pytest.approx((squash(2.0 + 0.292) + squash(-2.5)) / 4, abs=1e-12)
    whole = 2.0 * -0.74 + -2.5 * -0.74
    assert got["sent_compound"] == pytest.approx(squash(whole + np.sign(whole) * 0.292), abs=1e-12)
