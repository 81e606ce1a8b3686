"""Spelling variants, quality rules and hard negatives against plain versions, and their defined cases."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from launchcohort.llm import hard_negatives, quality_rules, queries, spelling
from launchcohort.llm.common import table

SF = "/root/testdata/sf0.001"
rnd = random.Random(17)


def plain_variants(docs, least=7, count=2):
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least and k >= count}
    gaps = defaultdict(set)  # whoever shares a word with one place left open, or is one letter longer
    for w in n:
        for k in range(len(w)):
            gaps[w[:k] + "\0" + w[k + 1:]].add(w)
    near = {w: set() for w in n}
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    for w in n:
        for k in range(len(w)):
            v = w[:k] + w[k + 1:]
            if v in n:
                near[w].add(v)
                near[v].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def variants(df, **more):
    out = spelling.spelling_variants(df, **more).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted(map(tuple, out.collect()))


def test_variants_of_whole_table(spark):
    docs = table(spark, SF, "documents")
    want = plain_variants([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = sorted(map(tuple, queries.QUERIES["op11_spelling_variants"](spark, SF).collect()))
    assert got == want and sum(w[4] > 0 for w in want) > 50


@pytest.mark.parametrize("dense", [4096, 2])
def test_variants_small_and_hot_keys(spark, dense):
    letters = "aabé"
    made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(7, 10))) for _ in range(500)]
    long = "abcdefghij" * 50
    made += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", long, long + "x", long[:200] + "y" + long[201:], "×÷×÷×÷×"]
    texts = [" ".join(made), " ".join(m.upper() for m in made), " ".join(["qrstuvw"] * 400 + ["qrstuvwx"] * 30 + ["qrstuvyx"] * 3), None, "", "short word", "1234567 _______"]
    rows = [(i, t, "w") for i, t in enumerate(texts)] + [(None, texts[0], None), (0, texts[0], "w")]
    got = variants(spark.createDataFrame(rows, "doc_id long, text string, word string"), dense=dense)
    want = plain_variants([(r[0], r[1]) for r in rows])
    assert got == want
    assert any(w[:3] == ("qrstuvyx", "qrstuvwx", "qrstuvw") for w in want)  # a chain of forms
    assert any(len(w[0]) > 400 and w[4] for w in want)


def test_variants_of_nothing(spark):
    assert variants(spark.createDataFrame([], "doc_id long, text string")) == []
    assert variants(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")) == []


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    n = Counter(windows)
    repeated = {k + d for k, w in enumerate(windows) if n[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_against_plain(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    rows += [(9001, None), (9002, ""), (9003, " \t\n\x0b\x0c\r"), (9004, "a b a b a b a"), (9005, "x " * 60), (9006, "one\n\none\n one\n\t\n"), (9007, "     x\U0001F600"),
             (9008, "a b c d a b c"), (9009, "a b c " * 30 + "q w e r t y " + "\n# | <b>"), (9010, " ".join(rnd.choice("abcd") for _ in range(60_000))), (9011, "a b a b"), (None, "a b c")]
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, words string, stats double")
    got = quality_rules.statistics(df).select("row.doc_id", "row.words", *COUNTS).collect()
    assert sorted(((r.doc_id or -1), *(r[c] for c in COUNTS)) for r in got) == sorted(((i or -1), *plain_counts(t)) for i, t in rows)
    assert {r.words for r in got} == {"x"}


def test_windows_whose_hashes_clash_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "PLACES", 59)  # five bits of hash: nearly every window meets another
    rows = [(k, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 60)))) for k in range(200)]
    out = quality_rules.statistics(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.select("row.doc_id", "n_repeat_words").collect())) == [(i, plain_counts(t)[4]) for i, t in rows]


def clean_text(seed, n=80):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmno") for _ in range(r.randint(2, 8))) for _ in range(n)) + "."


def junk_text(seed):
    words = clean_text(seed).split()
    return " ".join(w.upper() + "!!" for w in words) if seed % 2 else " ".join(w + " |" for w in words)


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(k, clean_text(k)) for k in range(600)] + [(1000 + k, junk_text(k)) for k in range(200)]
    labels = [(i, int(i < 1000)) for i, _ in rows if i % 4] + [(0, None), (None, 0), (4, 0), (4, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_rules_judge_held_out_texts(judged):
    docs, labels = judged
    got = {r.doc_id: r.kept for r in quality_rules.quality(docs, labels).select("row.doc_id", "kept").collect()}
    assert len(got) == 800
    assert all(got[i] for i in got if i < 1000) and not any(got[i] for i in got if i >= 1000)


def test_rules_are_an_ordered_expression(spark, judged):
    docs, labels = judged
    stats = quality_rules.statistics(docs)
    rules = quality_rules.learn(quality_rules.labelled_rows(stats, labels, "doc_id", "quality", 10_000))
    assert 1 <= len(rules) <= 4 and all(s in quality_rules.STATISTICS and sign in (">", "<=") for r in rules for s, sign, _ in r)
    sql = quality_rules.as_sql(rules)
    assert sql.startswith("CASE WHEN stats.") and sql.endswith("ELSE true END") and quality_rules.as_sql([]) == "true"
    # The expression says what a plain walk through the list says.
    for r in stats.withColumn("kept", F.expr(sql)).collect():
        hit = any(all((r.stats[s] > v) == (sign == ">") for s, sign, v in rule) for rule in rules)
        assert r.kept == (not hit)


def test_grown_condition_is_the_best_by_plain_search(spark):
    """The first condition is the one of the highest gain among all thresholds, found row by row."""
    r = np.random.default_rng(4)
    rows = []
    for k in range(900):
        bad = k % 3 == 0
        values = {s: float(r.normal(1.0 if bad and s == "marks_x" else 0.0)) for s in quality_rules.STATISTICS}
        values["mark_share"] = float(r.normal(3.0 if bad else 0.0))
        rows.append((values, bad, bool(k % 5)))
    kind = "struct<" + ",".join(f"{s}:double" for s in quality_rules.STATISTICS) + ">"
    df = spark.createDataFrame([(tuple(v[s] for s in quality_rules.STATISTICS), b, g) for v, b, g in rows], f"stats {kind}, bad boolean, grow boolean")
    at = quality_rules.thresholds(df)
    best = (-1.0, None)
    grow = [(v, b) for v, b, g in rows if g]
    bad, good = sum(b for _, b in grow), sum(not b for _, b in grow)
    for s in quality_rules.STATISTICS:
        for cut in at[s]:
            for above in (False, True):
                hit = [b for v, b in grow if (v[s] > cut) == above]
                p, q = sum(hit), len(hit) - sum(hit)
                if p >= quality_rules.LEAST_ROWS:
                    g = p * (math.log2(p / (p + q)) - math.log2(bad / (bad + good)))
                    best = max(best, (g, hit), key=lambda x: x[0])
    ((s, sign, cut),), = quality_rules.learn(df, max_rules=1, max_conditions=1, least_right=0.5)
    assert sorted(b for v, b in grow if (v[s] > cut) == (sign == ">")) == sorted(best[1])


def test_quality_defined_cases(spark, judged):
    docs, labels = judged
    empty = spark.createDataFrame([], "doc_id long, text string, kept string, stats string")
    assert quality_rules.quality(empty, labels).count() == 0
    few = docs.limit(5)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.kept for r in quality_rules.quality(few, none).collect()} == {True}
    assert {r.kept for r in quality_rules.quality(few, labels.where("quality = 1")).collect()} == {True}
    clash = docs.limit(3).selectExpr("doc_id", "text", "'k' as kept", "1 as n_words", "2 as words", "3 as bad").unionByName(
        spark.sql("select cast(null as bigint) as doc_id, cast(null as string) as text, 'k' as kept, 1 as n_words, 2 as words, 3 as bad"))
    got = quality_rules.quality(clash.unionByName(clash), labels).select("row.*", F.col("kept").alias("verdict"), F.col("n_words").alias("n")).collect()
    assert len(got) == 8 and sum(not r.verdict for r in got) == 2 and all(r.kept == "k" and r.bad == 3 for r in got)


def test_quality_query_is_native(spark):
    out = queries.QUERIES["op12_quality_rules"](spark, SF)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert out.count() == table(spark, SF, "documents").count()


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (64, 64, 64), (33, 64, 130), (17, 1, 40), (100, 70, 65)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    r = np.random.default_rng(3)
    a, b = r.integers(-10**6, 10**6, (m, k)), r.integers(-10**6, 10**6, (k, n))
    assert (hard_negatives.strassen(a, b, leaf=4) == a @ b).all()


def plain_negatives(rows, positives=5, negatives=3):
    """rows (id, label, vector); Python whole numbers throughout."""
    seen = {(i, y, tuple(math.floor(256 * x) for x in v)) for i, y, v in rows
            if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in (r for r in seen if r[0] % 50 == 0):
        score = {r: sum(x * y for x, y in zip(a[2], r[2])) for r in seen}
        best = sorted((r for r in seen if r[1] == a[1] and r != a), key=lambda r: (-score[r], r[0]))[:positives]
        for p in best:
            hit = [r for r in seen if r[1] != a[1] and 50 * score[p] <= 100 * score[r] <= 95 * score[p]]
            for k, r in enumerate(sorted(hit, key=lambda r: (-score[r], r[0]))[:negatives]):
                out.append((a[0], p[0], k + 1, r[0], score[p], score[r]))
    return sorted(out)


def test_negatives_of_whole_table(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    got = sorted(map(tuple, queries.QUERIES["op13_hard_negatives"](spark, SF).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))
    assert got == plain_negatives(rows) and len(got) > 5


KIND = "id long, label int, vector array<float>, score string, mark int"


def made_rows(n=420, dims=6):
    r = random.Random(9)
    rows = [(k, r.randrange(4), [round(r.uniform(-1, 1), 1) for _ in range(dims)]) for k in range(n)]
    rows += [(n + k, k % 4, rows[0][2]) for k in range(60)]  # one very common vector, many ties
    rows += [rows[0], rows[7], (n + 100, None, [1.0] * dims), (n + 101, 1, None), (n + 102, 1, [1.0, None]), (n + 103, 1, [float("nan")] * dims),
             (n + 104, 1, [float("inf")] * dims), (None, 1, [1.0] * dims), (n + 105, 2, [1.0, 0.5]), (n + 106, 2, []), (n + 107, 3, [0.5] * (dims + 3))]
    return [(i, y, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, y, v in rows]


@pytest.mark.parametrize("at_once", [16_384, 4])
def test_negatives_ties_nulls_and_chunks(spark, monkeypatch, at_once):
    rows = made_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND)
    got = hard_negatives.hard_negatives(df, F.col("id") % 50 == 0, anchors_at_once=at_once)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows) != []


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in made_rows()], KIND)
    assert hard_negatives.hard_negatives(df.limit(0), F.col("id") % 50 == 0).count() == 0
    assert hard_negatives.hard_negatives(df, F.col("id") == 49).where("positive_id is null").count() == 0
    assert hard_negatives.hard_negatives(df, F.lit(False)).count() == 0
    assert hard_negatives.hard_negatives(df.where("label = 1"), F.col("id") % 50 == 0).count() == 0


def test_heaps_merge_in_any_order():
    r = np.random.default_rng(1)
    rows = [(int(s), int(i), 0) for i, s in enumerate(r.integers(0, 6, 40))]
    want = sorted(rows, key=lambda x: (-x[0], x[1]))[:5]
    for _ in range(5):
        r.shuffle(rows)
        h = hard_negatives.Heaps(1, 5)
        for k in range(0, 40, 7):
            part = rows[k:k + 7]
            h.add(np.array([0]), *(np.array([[x[c] for x in part]], np.int64) for c in range(3)), np.ones((1, len(part)), bool))
        assert list(zip(h.score[0].tolist(), h.id[0].tolist())) == [x[:2] for x in want]
