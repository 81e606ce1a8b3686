"""Operators against plain versions on small tables, and the cases every operator has a defined result for."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from launchcohort.llm import (components, cover_join, decontamination, line_dedup, minhash, mixing, queries, secrets,
                              substring_dedup, token_counts, toxicity, url_filter)

SCHEMA = "doc_id long, text string, source string, n_chars long, row string, kept string, node string, size long"
TOKENS = public_tokenizers.path("byte_bpe_50k.json")
rnd = random.Random(5)
WORDS = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(400)]


def text(n, seed):
    r = random.Random(seed)
    return "".join(r.choice(WORDS) + r.choice([" ", " ", " ", "\n", "  "]) for _ in range(n))


def corpus():
    base = [text(60, k) for k in range(30)]
    passage = text(50, 999)
    rows = [None, "", "   \n\t", "one", "The " * 300, "LINE a\n line A \nx", base[0], base[0], base[0] + " extra"]
    rows += base + [b + "\nshared Line here \n" + passage for b in base[:12]] + [text(20_000, 77)]
    return [(k, t, f"s{k % 3}" if k % 7 else None, 0, "clash", "clash", "clash", 5) for k, t in enumerate(rows)] + [(6, base[0], "s0", 0, "clash", "clash", "clash", 5)]


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({i: i + 32 for i in range(65, 91)})


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_lines(docs, none, limit):
    n = Counter(k for r in ROWS for k in {key(x) for x in (r[1] or "").split("\n")} - {""})
    want = sorted((r[0], len(ls := (r[1] or "").split("\n")), len(ls) - len(k := [x for x in ls if n[key(x)] < 3 or not key(x)]), "\n".join(k)) for r in ROWS)
    got = line_dedup.line_dedup(docs, min_docs=3, broadcast_keys=limit, filter_bits=1 << 10).select("row.doc_id", "n_lines", "n_dropped", "kept")
    assert sorted(map(tuple, got.collect())) == want and any(w[2] for w in want)
    assert line_dedup.line_dedup(none).count() == 0
    first = line_dedup.line_dedup(docs, min_docs=3, keep="first").agg(F.sum("n_dropped")).first()[0]
    assert 0 < first < sum(w[2] for w in want)


def test_substrings(docs, none):
    w = {i: (r[1] or "").encode().split() for i, r in enumerate(ROWS)}
    n = Counter(tuple(x[s:s + 35]) for x in w.values() for s in range(len(x) - 34))
    want = []
    for i, x in w.items():
        gone = {s + k for s in range(len(x) - 34) if n[tuple(x[s:s + 35])] > 1 for k in range(35)}
        want.append((ROWS[i][0], len(x), len(gone), b" ".join(y for k, y in enumerate(x) if k not in gone).decode()))
    got = substring_dedup.substring_dedup(docs).select("row.doc_id", "n_words", "n_removed", "kept")
    assert sorted(map(tuple, got.collect())) == sorted(want) and sum(x[2] > 0 for x in want) > 10
    assert substring_dedup.substring_dedup(none).count() == 0


def test_equal_windows_choose_equal_symbols():
    r = np.random.default_rng(2)
    inner = r.integers(0, 5, 60).astype(np.uint64)
    a, b = (np.concatenate([r.integers(0, 5, 40).astype(np.uint64), inner, r.integers(0, 5, 30).astype(np.uint64)]) for _ in range(2))
    (at, x, names), (_, y, others) = (substring_dedup.chosen(s, np.array([0, len(s)])) for s in (a, b))
    for s in range(40, 65):
        assert (x[s] < 0) == (y[s] < 0) and (x[s] < 0 or names[x[s]] == others[y[s]])


def test_secrets(spark, none):
    texts = [None, "", "password = abcdefghijkl!", 'x password=secret:abcdefghijklmnop "API_KEY": \'0123456789abcdef\'', "AKIAABCDEFGHIJKLMN 0123456789abcdef0123",
             "é" * 5 + " token:short deadbeefdeadbeefdeadbeef", "key zX8kQ2vLr9TpW4mYb7Nc3Hs6 end", "just the ordinary words of people here " * 3]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    some = [("".join(rnd.choice(secrets.LETTERS[:62]) for _ in range(24)), 1) for _ in range(200)] + [(w, 0) for w in ["ordinary", "words", "people", "internationalization", "configuration"] * 40]
    got = {r.doc_id: r for r in secrets.secret_spans(d, spark.createDataFrame(some, "s string, random int")).select("row.doc_id", secrets.joined(F.col("base")).alias("b"), secrets.joined(F.col("spans")).alias("a")).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 12]
        found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18] + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        assert got[i].b == ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))
    assert got[6].a == "random:4:28" and got[7].a == ""
    assert secrets.secret_spans(none).count() == 0


def plain_ratio(model, s):
    at = {c: k for k, c in enumerate(secrets.LETTERS)}
    return sum(model[len(secrets.LETTERS) * at[a] + at[b]] for a, b in zip(s, s[1:])) / (len(s) - 1)


def test_secrets_of_the_models_own_labels(spark):
    """Strings drawn from several alphabets, put into given texts whose model is trained on those very texts."""
    r = random.Random(8)
    alphabets = [secrets.LETTERS[:62], "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz0123456789", secrets.LETTERS[:64]]
    texts = [(d.doc_id, d.text or "") for d in queries.table(spark, "/root/testdata/sf0.001", "documents").collect()]
    drawn = {}
    for k in range(160):
        s = "".join(r.choice(alphabets[k % 4]) for _ in range((12, 16, 20, 24, 32)[k % 5]))
        i = k % len(texts)
        texts[i] = (texts[i][0], f"{texts[i][1]} {s} end")
        drawn[s] = len(s)
    texts += [(90_000, "zX8kQ2vLr9TpW4mYb7Nc deadbeefdeadbeef01/qT7vXz2LpR8wKc4M end"), (90_001, "word " * 50_000 + "qT7vXz2LpR8wKc4M"), texts[0]]
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, spans string, base int")
    out = secrets.secret_spans(d).select("row.doc_id", "row.base", F.col("spans").alias("found")).collect()
    got = [x.hit for row in out for x in row.found if x.kind == "random"]
    long = [s for s, n in drawn.items() if n >= 20]
    assert sum(s in got for s in long) >= 0.9 * len(long) and sum(s in got for s in drawn) >= 0.8 * len(drawn)
    mine = {*drawn, "zX8kQ2vLr9TpW4mYb7Nc", "qT7vXz2LpR8wKc4M", "/qT7vXz2LpR8wKc4M"}
    words = sum(len(t.split()) for _, t in texts)
    assert sum(s not in mine for s in got) <= words * 50 / 1e6
    by_id = {row.doc_id: [(x.kind, x.start, x.end) for x in row.found] for row in out}
    # What lies beside a pattern's match inside a longer candidate is scored too.
    assert by_id[90_000] == [("random", 0, 20), ("hex", 21, 39), ("random", 39, 56)]
    assert by_id[90_001] == [("random", 250_000, 250_016)] and {row.base for row in out} == {1}
    same = [sorted(map(tuple, row.found)) for row in out if row.doc_id == texts[0][0]]
    assert len(same) == 2 and same[0] == same[1]


def test_likelihood_ratio_is_the_plain_one(spark):
    some = [("".join(rnd.choice(secrets.LETTERS[:62]) for _ in range(24)), 1) for _ in range(50)] + [(w, 0) for w in WORDS]
    model = secrets.train(spark.createDataFrame(some, "s string, random int"))
    df = spark.createDataFrame([(s, model) for s, _ in some[::7] if len(s) > 1], "s string, scores array<double>")
    for row in df.selectExpr("s", secrets.likelihood_ratio("s") + " as ratio").collect():
        assert row.ratio == pytest.approx(plain_ratio(model, row.s))


def test_token_counts_at_every_prefix(spark, docs, none):
    lib, enc = Tokenizer.from_file(TOKENS), token_counts.encoder(TOKENS)
    for s in ["", " a  b\n\n c'll <|endoftext|>x", "don't 'l 'lle  漢字🙂é\x1c", text(30, 4), "aaaaaaaaaaaaaaaaaaaa   "]:
        assert enc.prefix_counts(s) == [len(lib.encode(s[:k], add_special_tokens=False).ids) for k in range(len(s) + 1)]
    got = {(r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs, TOKENS).select("row.doc_id", "n_bytes", "n_tokens").collect()}
    assert got == {(r[0], len((r[1] or "").encode()), len(lib.encode(r[1] or "", add_special_tokens=False).ids)) for r in ROWS}
    cut = token_counts.with_prefix_counts(docs.where("doc_id = 9"), TOKENS).select("row.text", token_counts.cut("row.text", "prefix_counts", 20).alias("cut")).first()
    assert len(lib.encode(cut.cut, add_special_tokens=False).ids) <= 20 and cut.text.startswith(cut.cut) and len(cut.cut) > 20
    assert token_counts.token_counts(none, TOKENS).count() == 0


def test_toxicity(spark, none):
    clean = [(k, text(40, k + 5000)) for k in range(300)]
    bad = [(1000 + k, text(20, k) + (" grumbler " if k % 2 else " nasty ") + text(20, k + 1)) for k in range(60)]
    new = [(5000, "you grumbl3r"), (5001, "You, g r u m b l e r, here"), (5002, "n4sty and nasssty"), (5003, None), (5004, ""), (5005, text(30, 6000))]
    d = spark.createDataFrame(clean + bad + new, "doc_id long, text string")
    y = spark.createDataFrame([(i, 0) for i, _ in clean] + [(i, 1) for i, _ in bad] + [(7, None)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity(d, y).select("row.doc_id", "score").collect()}
    assert all(got[i] > 0.5 for i in (5000, 5001, 5002)) and all(got[i] < 0.3 for i in (5003, 5004, 5005)) and got[5003] == got[5004]
    assert all(got[i] > 0.5 for i, _ in bad) and sum(got[i] > 0.3 for i, _ in clean) == 0
    assert toxicity.toxicity(none, y).count() == 0
    assert {r.score for r in toxicity.toxicity(d, y.where("toxic > 5")).select("score").collect()} == {0.0}


def test_toxicity_learns_from_repeats_once(spark, monkeypatch):
    clean = [(k, text(40, k + 5000)) for k in range(100)]
    bad = [(1000 + k, text(20, k) + " grumbler " + text(20, k + 1)) for k in range(40)]
    d, y = spark.createDataFrame(clean + bad, "doc_id long, text string"), spark.createDataFrame([(i, int(i >= 1000)) for i, _ in clean + bad], "doc_id long, toxic int")
    one = next(t for i, t in bad if not spark.range(1).select(toxicity.held_out(F.lit(i))).first()[0])
    again = d.unionByName(d.crossJoin(spark.range(50)).where(F.col("text") == one).select("doc_id", "text"))
    # One id with many texts of its own is bounded too.
    many = d.unionByName(spark.range(400).select(F.lit(next(i for i, t in bad if t == one)).alias("doc_id"), F.concat(F.lit("text number "), F.col("id")).alias("text")))
    cost, seen, fit = spark.sparkContext.broadcast(toxicity.letter_model(d)), [], toxicity.logistic
    monkeypatch.setattr(toxicity, "logistic", lambda found, *a: seen.append(len(found)) or fit(found, *a))
    a, b = toxicity.train(d, y, cost), toxicity.train(again, y, cost)
    assert a[:2] == b[:2] and np.array_equal(a[2], b[2]) and seen[0] == seen[1]
    toxicity.train(many, y, cost, max_labelled=150)
    assert seen[2] <= 150


def test_cover_join(spark, monkeypatch):
    monkeypatch.setattr(cover_join, "CELL", 40)
    r = np.random.default_rng(3)
    near = r.normal(size=8)
    x = [r.normal(size=8).tolist() for _ in range(120)] + [(near + r.normal(size=8) * 0.08).tolist() for _ in range(60)] + [(near * 3).tolist()] * 3
    rows = [(i, v, i % 2) for i, v in enumerate(x)] + [(900, None, 0), (901, [0.0] * 8, 0), (902, [float("nan")] * 8, 1), (903, x[0], None), (904, [1.0, None] + [0.0] * 6, 1), (905, [1.0], 1), (906, [], 0)]
    got = {r_.id: (r_.n_links, r_.component_id) for r_ in cover_join.cover_join(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    part, links = {i: i for i, *_ in rows}, Counter()
    ok = [(i, np.array(v), y) for i, v, y in rows if i < 900]
    for a in ok:
        for b in ok:
            if a[0] != b[0] and a[2] == b[2] and a[1] @ b[1] >= 0.98 * np.linalg.norm(a[1]) * np.linalg.norm(b[1]):
                links[a[0]] += 1
                p, q = part[a[0]], part[b[0]]
                part = {k: min(p, q) if v in (p, q) else v for k, v in part.items()}
    assert got == {i: (links[i], part[i]) for i, *_ in rows} and max(links.values()) > 5
    assert cover_join.cover_join(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0


def test_mix(docs, none):
    out = mixing.mix(docs, docs_per_block=4).select("row.doc_id", "row.source", "size", "source_size", "target", "taken", "shard")
    rows = out.collect()
    assert sorted(map(str, out.collect())) == sorted(map(str, rows))
    assert len(rows) == len(ROWS) and len({r.shard for r in rows}) > 2
    assert all(r["size"] == len((next(t for i, t, *_ in ROWS if i == r.doc_id) or "").encode().split()) and 0 <= r.taken <= 2 * r["size"] for r in rows)
    for s in {r.source for r in rows}:
        assert abs(sum(r.taken for r in rows if r.source == s) - next(r.target for r in rows if r.source == s)) <= 0.5
    names = sorted({r.source for r in rows if r.source}) + [None]
    size = {s: sum(r["size"] for r in rows if r.source == s) for s in names}
    weight, full = dict(zip(names, (3, 1, 2, 3))), set()
    while True:
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in full)
        share = {s: 2 * size[s] if s in full else left * weight[s] / sum(weight[x] for x in names if x not in full) for s in names}
        more = {s for s in names if s not in full and share[s] > 2 * size[s]}
        if not more:
            break
        full |= more
    assert all(r.target == pytest.approx(share[r.source]) for r in rows)
    assert mixing.mix(none).count() == 0


def test_wide_draws_are_hypergeometric(spark):
    rows = [("s", k, q, n, m, 7) for k in range(60) for q, n, m in [(60, 100, 900), (40, 5000, 35), (2000, 70, 9000), (900, 1000, 1000), (50_000, 300_000, 100_000)]]
    d = spark.createDataFrame(rows, "source_key string, node long, q long, n long, m long, seed int").selectExpr("*", "greatest(0, q - m) as lo", "least(q, n) as hi")
    got = d.selectExpr("q", "n", "m", f"{mixing.uniform(1)} as u", f"{mixing.hypergeometric()} as k").collect()
    assert len(got) == len(rows)
    cdf = {}
    for x in got:
        if (x.q, x.n, x.m) not in cdf:
            k = np.arange(max(0, x.q - x.m), min(x.q, x.n) + 1)
            f = np.concatenate([[0], np.cumsum(np.log(np.arange(1, x.n + x.m + 1)))])
            p = f[x.n] - f[k] - f[x.n - k] + f[x.m] - f[x.q - k] - f[x.m - x.q + k]
            p = np.cumsum(np.exp(p - p.max()))
            cdf[x.q, x.n, x.m] = k[0], p / p[-1]
        lo, p = cdf[x.q, x.n, x.m]
        # The number's place among the sums, but for their rounding.
        assert lo + np.searchsorted(p, x.u - 1e-6) <= x.k <= lo + np.searchsorted(p, x.u + 1e-6)


def test_near_duplicates(docs, none):
    for words_per in (2, 5):
        s = {}
        for i, t, *_ in ROWS:
            w = (t or "").encode().lower().split()
            s[i] = {tuple(w[k:k + words_per]) for k in range(len(w) - words_per + 1)} if len(w) >= words_per else {tuple(w)} if w else set()
        part = {i: i for i in s}
        for a in s:
            for b in s:
                if a < b and s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b]):
                    p, q = part[a], part[b]
                    part = {k: min(p, q) if v in (p, q) else v for k, v in part.items()}
        got = {r.id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, words_per).collect()}
        assert got == {i: (len(s[i]), part[i]) for i in s}
    assert minhash.near_duplicates(none).count() == 0


def test_large_families_of_edited_copies(spark):
    base = text(150, 1).split()
    r = random.Random(4)
    family = [" ".join(w if r.random() > 0.04 else r.choice(WORDS) + str(r.randint(0, 9)) for w in base) for _ in range(70)]
    sets = [set(zip(t.split(), t.split()[1:])) for t in family]
    part = list(range(70))
    for a in range(70):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = part[a], part[b]
                part = [min(p, q) if v in (p, q) else v for v in part]
    d = spark.createDataFrame(list(enumerate(family)), "doc_id long, text string")
    assert {x.id: x.component_id for x in minhash.near_duplicates(d, 2).collect()} == dict(enumerate(part))


def test_rare_meetings_lose_no_pair(spark):
    r = random.Random(9)
    core = list(range(1, 41))
    sets = []
    for k in range(120):  # families with own, shared and missing elements, of like and unlike sizes
        s = set(r.sample(core, r.randint(30, 40))) | {r.randint(100, 130) for _ in range(r.randint(0, 8))} | {1000 + 20 * k + j for j in range(r.randint(0, 4))}
        sets.append(s)
    sets += [{5}, {5, 6}, {7}, {100, 101, 102}, {100, 101, 102, 103}]
    sets += [set(core) - {k} for k in range(1, 6)] + [set(core) | {900}]  # alike in 39 of 40 and more
    pack = lambda s: np.sort(np.array(list(s), np.uint64)).tobytes()
    d = spark.createDataFrame([(k.to_bytes(2, "big"), pack(s)) for k, s in enumerate(sets)], "node binary, shingles binary")
    for similarity in (60, 80, 95):
        got = {frozenset((int.from_bytes(x.a, "big"), int.from_bytes(x.b, "big"))) for x in minhash.rare_meetings(d, similarity).collect()}
        want = {frozenset((a, b)) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])}
        assert want and want <= got and len(got) < len(sets) * (len(sets) - 1) / 2
    assert minhash.rare_meetings(d.limit(0), 80).count() == 0


def test_components(spark):
    e = [(k, k + 1) for k in range(20)] + [(50, k) for k in range(51, 90)] + [(95, 95), (None, 3)]
    got = dict(map(tuple, components.components(spark.createDataFrame(e, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(21)}, **{k: 50 for k in range(50, 90)}}


def test_urls(spark):
    rows = [(0, None), (1, "no scheme"), (2, "http://A.Example.ORG/es/x?q"), (3, "http://example.org/en/12#t"), (4, "https://org/"), (5, "http://badorg/"), (6, "http://x.com/fr/"),
            (7, "http://x.com/de/1"), (8, "http://x.com"), (9, "http://casino-bets.example.net/free"), (10, "http://river.example.net/birds"), (11, "http://x.org")]
    got = {r.page_id: r for r in url_filter.url_filter(spark.createDataFrame(rows, "page_id long, url string"), url_filter.labelled_urls(spark)).select("row.page_id", "host", "path", "rule", "verdict").collect()}
    assert [got[i].rule for i in range(12)] == [None, None, "example.org/es/", "example.org/en/1", "org/", None, "com/fr/", "com/de/", None, None, None, None]
    assert (got[2].host, got[2].path, got[1].host, got[0].path) == ("a.example.org", "/es/x", "", "") and [got[i].verdict for i in (2, 3, 4, 6, 7, 9, 10)] == ["block", "block", "allow", "allow", "block", "block", "allow"]


def test_urls_of_a_whole_table_by_plain_code(spark):
    """Host, path and rule by regular expressions, the score from a plain dictionary of weights."""
    pages = queries.table(spark, "/root/testdata/sf0.001", "pages").select("page_id", "url")
    odd = [(70_001, None, "c"), (70_002, "", "c"), (70_003, "http://A.org/es/" + "x1" * 50_000, "c"), (70_004, "a://b://c/d?e://f", "c"), (70_004, "a://b://c/d?e://f", "c")]
    rows = pages.selectExpr("page_id", "url", "'c' as score").unionByName(spark.createDataFrame(odd, "page_id long, url string, score string"))
    labelled = url_filter.labelled_urls(spark)
    w, b = url_filter.train(labelled)
    weight = {k: x for k, x in enumerate(w) if x}
    got = sorted(url_filter.url_filter(rows, labelled).select("row.*", F.struct("host", "path", "rule", "score", "verdict").alias("got")).collect(), key=str)
    assert len(got) == pages.count() + 5 and {r.score for r in got} == {"c"}
    for r in got:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r.url or "")
        host, path = ("".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in m[1]), m[2]) if m else ("", "")
        fits = [(len(k), k, v) for k, v in url_filter.RULES if re.search(r"(^|\.)" + re.escape(k.split("/", 1)[0]) + "$", host) and path.startswith("/" + k.split("/", 1)[1])]
        grams = {"h" + f"^{host}$"[i:i + n] for n in (2, 3, 4) for i in range(len(host) + 3 - n)} if host else set()
        short = re.sub(r"\d+", "0", path)
        grams |= {"p" + short[i:i + n] for n in (2, 3, 4) for i in range(len(short) + 1 - n)}
        seen = {zlib.crc32(g.encode()) % url_filter.BUCKETS for g in grams}
        z = sum(weight.get(k, 0.0) for k in seen) / max(1, len(seen)) ** 0.5 + b
        assert (r.got.host, r.got.path, r.got.rule) == (host, path, max(fits)[1] if fits else None)
        assert r.got.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
        assert r.got.verdict == (max(fits)[2] if fits else "block" if r.got.score >= 0.5 else "allow")
    assert url_filter.url_filter(rows.limit(0), labelled).count() == 0


def test_labelled_hosts_are_not_the_tables(spark):
    names = {u.split("/")[0].removesuffix(".example") for u in url_filter.UNWANTED}
    hosts = {r[0] for r in queries.table(spark, "/root/testdata/sf0.1", "pages").selectExpr("regexp_extract(url, '://([^/?#]*)', 1)").distinct().collect()}
    assert not [h for h in hosts if any(re.fullmatch(r"([a-z]+\.)?" + re.escape(n.split(".")[-1]) + r"\.example\.\w+", h) for n in names)]


def test_leaks(spark, docs, none):
    item = [rnd.choice(WORDS) for _ in range(30)]
    edited = [w if k % 6 else "changed" for k, w in enumerate(item)]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(900, text(40, 1) + " " + " ".join(item).upper() + " " + text(9, 2)), (901, text(9, 3) + " " + ", ".join(edited) + "."), (902, " ".join(item[:8]) + text(30, 5))], "doc_id long, text string"))
    b = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short"), (4, "")], "item_id long, text string")
    got = {(r.id, r.item): r.score for r in decontamination.contaminated(d, b).collect()}
    assert set(got) == {(900, 1), (901, 1)} and got[900, 1] == 1.0 and 0.5 < got[901, 1] < 1
    assert decontamination.contaminated(none, b).count() == 0 and decontamination.contaminated(d, b.where("item_id > 9")).count() == 0


def test_leaks_of_unequal_frequency(spark):
    r = random.Random(8)
    item = [r.choice(WORDS) for _ in range(30)]
    edited = [w if k % 6 else "changed" for k, w in enumerate(item)]
    rows = [(0, text(20, 1) + " " + " ".join(item) + " " + text(20, 2))]
    rows += [(k, text(20, 100 + k) + " " + " ".join(edited) + " " + text(20, 200 + k)) for k in range(1, 41)]
    d, b = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {x.id for x in decontamination.contaminated(d, b).collect()} == set(range(41))


def test_leaks_of_short_items(spark):
    d = spark.createDataFrame([(1, "Which river, is LONGEST? the Nile"), (2, "which river is the longest"), (3, "nile"), (4, "which river is longest"), (5, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "Which river is longest?"), (2, "Nile."), (3, "?"), (4, "")], "item_id long, text string")
    got = {(x.id, x.item, x.score, x.end) for x in decontamination.contaminated(d, b).collect()}
    assert got == {(1, 1, 1.0, 4), (4, 1, 1.0, 4), (1, 2, 1.0, 6), (3, 2, 1.0, 1)}


def test_leaks_without_three_equal_words_in_a_row(spark):
    r = random.Random(12)
    item = r.sample(WORDS, 29)
    put_in = " ".join(w + " more" * (k % 2) for k, w in enumerate(item))
    replaced = " ".join(w if k % 3 != 2 else "other" for k, w in enumerate(item))
    d = spark.createDataFrame([(1, text(30, 1) + put_in + " " + text(30, 2)), (2, text(30, 3) + replaced + " " + text(30, 4)), (3, text(90, 5))], "doc_id long, text string")
    b = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {x.id: x.score for x in decontamination.contaminated(d, b).collect()}
    assert set(got) == {1, 2} and got[1] > 0.7 and 0.5 < got[2] < 0.6


def plain_score(item, doc):
    best, row = 0, [0] * (len(doc) + 1)
    for w in item:
        new = [0]
        for k, v in enumerate(doc):
            new.append(max(0, row[k] + (2 if v == w else -1), row[k + 1] - 1, new[k] - 1))
        row, best = new, max(best, *new)
    return best / (2 * len(item))


@pytest.mark.parametrize("threshold", [0.5, 0.7, 1.0])
def test_leaks_against_plain_alignment(spark, monkeypatch, threshold):
    r = random.Random(9)
    few = WORDS[:60]
    items = [[r.choice(few) for _ in range(r.randint(8, 40))] for _ in range(12)]
    docs = []
    for k in range(90):
        copy = [x for w in items[k % 12] for x in r.choice([[w]] * (1 + k % 9) + [[], [r.choice(few)], [w, r.choice(few)]])]
        docs.append([r.choice(few) for _ in range(r.randint(0, 60))] + copy + [r.choice(few) for _ in range(r.randint(0, 60))])
    want = {(d, i): s for d, x in enumerate(docs) for i, item in enumerate(items) if (s := plain_score(item, x)) >= threshold}
    d = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(docs)], "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    for item_words in (1 << 20, 100):
        assert {(x.id, x.item): x.score for x in decontamination.contaminated(d, b, threshold=threshold, item_words=item_words).collect()} == want
    assert want or threshold == 1.0
    # Few hits at a time give the same passages' scores.
    words, outer = decontamination.word_hashes([" ".join(x).encode() for x in docs])
    group = decontamination.Items(None, [decontamination.word_hashes([" ".join(x).encode()])[0] for x in items], threshold)
    group.seed(np.ones(len(group.vocabulary)))
    monkeypatch.setattr(decontamination, "HITS", 50)
    best = {}
    for item, lo, hi in group.passages(group.numbers(words), outer):
        for i, a, s in zip(item.tolist(), lo.tolist(), group.scores(group.numbers(words), item, lo, hi, {})[:, 0] / (2 * group.size[item])):
            at = int(np.searchsorted(outer, a, "right")) - 1, i
            best[at] = max(best.get(at, 0), s)
    assert {k: s for k, s in best.items() if s >= threshold} == want


def test_pipeline_keeps_columns(spark, tmp_path):
    rows = [(i, t, "en", s, n) for i, t, s, n, *_ in ROWS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ROWS[20][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    # Exact and near copies of document 6 go; 20 is a benchmark item, and one of its copies holds it.
    assert 6 in out and 7 not in out and 20 not in out and {0, 1, 2, 3} <= set(out)
    assert list(out[6].asDict()) == ["doc_id", "source", "size", "source_size", "target", "taken", "shard"]


def test_queries_are_registered():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{k}" for k in range(1, 11)]
    assert hashlib.sha256(b"").hexdigest()  # the digest of an empty text is defined
