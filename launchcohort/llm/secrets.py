"""Secrets in texts: fixed patterns, and strings that look drawn rather than written.

Patterns first: a text is split at a pattern, and running lengths of what lies between the matches
and of these give their places. Then a Markov model of random strings and one of ordinary
identifiers, both over neighbouring characters, score every further candidate by the logarithm of
their likelihood ratio, a mean per character that short candidates must pass by more. They are trained
from labelled strings: drawn ones of the usual alphabets are random, words that several texts share are
ordinary; any other labelled table will do.
Everything is built-in functions; only the table of pairs (one per pair of letters) reaches the driver.

Defined results: null is an empty text without secrets; places are code points, end exclusive; a
pattern's match is found leftmost and without overlap, then dropped if too short; of a candidate that
overlaps pattern matches the parts beside them are scored; candidates have 12 characters or more; without
labelled strings of both sorts nothing is added; repeated rows have equal results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from launchcohort.session import written

# The patterns of the contract, with the least length of what counts. For `access` and
# `hex` the length is part of the pattern: a shorter match can hide no longer one.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")

LEAST = 12
CANDIDATE = r"[A-Za-z0-9+/_=-]{%d,}" % LEAST
LETTERS = "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)])) + "+/_=-"
SPAN = "struct<start:bigint,end:bigint,rank:int,kind:string,hit:string>"
# A candidate's mean score must pass MEAN, and its sum TOTAL, which asks more of short ones.
MEAN, TOTAL = 0.4, 9.0
MAX_DOCS, SHARED_BY, DRAWN = 4000, 3, 2000


def _no_spans() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def spans(text: Column, pattern: str, kind: str) -> Column:
    """Structs (start, end, rank, kind, hit) of a pattern's matches, in their order."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), hits, lambda gap, hit: F.struct(F.length(gap).cast("bigint").alias("gap"), hit.alias("hit")))

    def add(state, x):
        start = state["at"] + x["gap"]
        end = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), end.alias("end"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one.cast(SPAN))).alias("out"))

    return F.aggregate(pieces, F.struct(F.lit(0).cast("bigint").alias("at"), _no_spans().alias("out")), add, lambda s: s["out"])


def base_spans(text: Column) -> Column:
    """The patterns' spans by start, then kind."""
    # Cheap tests first: most texts hold none of them.
    assign = F.filter(spans(text, ASSIGN, "assign"), lambda x: F.length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= 12)
    return F.array_sort(F.concat(F.when(text.rlike(ASSIGN), assign).otherwise(_no_spans()),
                                 F.when(text.contains("AKIA"), spans(text, ACCESS, "access")).otherwise(_no_spans()),
                                 F.when(text.rlike(HEX), spans(text, HEX, "hex")).otherwise(_no_spans())))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def drawn_strings(spark: SparkSession, count: int = DRAWN) -> DataFrame:
    """(s, random): strings drawn from the alphabets that keys are written in, made of hashes of numbers.

    Base 64, its form for urls, letters and digits, small and capital letters with digits, small letters, hexadecimal.
    """
    plain = F.regexp_replace("b", "[+/=]", "")
    kinds = [F.col("b"), F.translate("b", "+/=", "-_"), plain, F.lower(plain), F.upper(plain), F.regexp_replace(F.lower("b"), "[^a-z]", ""), F.sha2(F.col("id").cast("string"), 256)]
    made = spark.range(count).select("id", F.base64(F.unhex(F.sha2(F.concat(F.lit("drawn "), F.col("id")), 256))).alias("b"))
    return made.select(F.explode(F.array(*kinds)).alias("s"), F.lit(1).alias("random"))


def ordinary_strings(docs: DataFrame, text: str = "text", max_docs: int = MAX_DOCS, shared_by: int = SHARED_BY) -> DataFrame:
    """(s, random): words that several texts share, each once, so that a secret met once teaches nothing.

    Of the distinct texts without a pattern's match the `max_docs` with the smallest hashes serve. The hashes
    are sorted alone; only the texts chosen are shuffled, copies of one after a task has made them one.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    none = ~(t.rlike(ASSIGN) | t.contains("AKIA") | t.rlike(HEX))
    keys = written(docs.where(none).select(F.xxhash64(t).alias("key")).distinct(), "text-keys")
    met = docs.select(t.alias("t"), F.xxhash64(t).alias("key")).join(F.broadcast(keys.orderBy("key").limit(max_docs)), "key")
    some = written(met.groupBy("key").agg(F.min("t").alias("t")), "labelled-texts")
    words = some.select(F.explode(F.array_distinct(F.regexp_extract_all("t", F.lit("[A-Za-z0-9+/_=-]{5,}"), F.lit(0)))).alias("s"))
    known = words.groupBy("s").count().where(F.col("count") >= shared_by)
    # A word in capitals is as ordinary as the word.
    return known.select(F.explode(F.array_distinct(F.array("s", F.upper("s"), F.initcap("s")))).alias("s"), F.lit(0).alias("random"))


def labelled_strings(docs: DataFrame, text: str = "text", max_docs: int = MAX_DOCS) -> DataFrame:
    """(s, random): drawn strings, and words of the texts."""
    return drawn_strings(docs.sparkSession).unionByName(ordinary_strings(docs, text, max_docs))


def train(labelled: DataFrame) -> list[float] | None:
    """log P(next | this) of random strings less that of ordinary ones, at len(LETTERS) * this + next."""
    pairs = (labelled.where("s is not null and random is not null and length(s) > 1")
             .select("random", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring("s", i, F.lit(2)))).alias("pair"))
             .where(F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$")).groupBy("random", "pair").count().collect())
    n = {(r["random"], r["pair"]): r["count"] for r in pairs}
    if {k for k, _ in n} != {0, 1}:
        return None
    total = {(k, a): sum(n.get((k, a + b), 0) for b in LETTERS) for k in (0, 1) for a in LETTERS}

    # Pairs that were seldom seen fall back on how common the second letter is.
    whole = {k: sum(total[k, a] for a in LETTERS) for k in (0, 1)}
    second = {(k, b): 0.99 * sum(n.get((k, a + b), 0) for a in LETTERS) / whole[k] + 0.01 / len(LETTERS) for k in (0, 1) for b in LETTERS}

    def p(k, a, b):
        return math.log((n.get((k, a + b), 0) + 5 * second[k, b]) / (total[k, a] + 5))

    return [p(1, a, b) - p(0, a, b) for a in LETTERS for b in LETTERS]


def likelihood_ratio(s: str, scores: str = "scores") -> str:
    """Its logarithm for a string, a mean over the pairs, as SQL; `scores` is the model's array column."""
    return f"""(aggregate(sequence(1, length({s}) - 1), 0D, (sum, i) -> sum + {scores}[
        {len(LETTERS)} * (instr('{LETTERS}', substring({s}, i, 1)) - 1) + instr('{LETTERS}', substring({s}, i + 1, 1)) - 1])
        / (length({s}) - 1))"""


def beside(text: str, more: str = "more", base: str = "base") -> str:
    """SQL for the parts of the candidates that lie outside all pattern spans and are long enough, as spans of `text`."""
    def part(start, end):
        one = f"named_struct('start', {start}, 'end', {end}, 'rank', {KINDS.index('random')}, 'kind', 'random', 'hit', substring({text}, int({start}) + 1, int({end} - {start})))"
        return f"if({end} - {start} >= {LEAST}, array({one}), cast(array() as array<{SPAN}>))"

    over = f"filter({base}, y -> x.start < y.end and y.start < x.end)"
    cut = f"""aggregate({over}, named_struct('at', x.start, 'out', cast(array() as array<{SPAN}>)),
        (s, y) -> named_struct('at', greatest(s.at, y.end), 'out', concat(s.out, {part('s.at', 'y.start')})),
        s -> concat(s.out, {part('s.at', 'x.end')}))"""
    return f"flatten(transform({more}, x -> if(exists({base}, y -> x.start < y.end and y.start < x.end), {cut}, array(x))))"


def secret_spans(docs: DataFrame, labelled: DataFrame | None = None, text: str = "text", mean: float = MEAN, total: float = TOTAL) -> DataFrame:
    """`row` (a struct of all input columns but the text), and arrays of spans: `base` of the patterns, `spans` of all."""
    model = train(labelled_strings(docs, text) if labelled is None else labelled)
    t = F.col("t")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != text]).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.select("row", "t", base_spans(t).alias("base"))
    if model is None:
        return rows.select("row", "base", F.col("base").alias("spans"))
    # One row with the model, of a fixed size.
    scores = docs.sparkSession.createDataFrame([(model,)], "scores array<double>")
    more = F.when(t.rlike(CANDIDATE), spans(t, CANDIDATE, "random")).otherwise(_no_spans())
    rows = rows.select("row", "t", "base", more.alias("more"))
    rows = rows.select("row", "base", F.expr(f"if(size(base) = 0, more, {beside('t')})").alias("more")).join(F.broadcast(scores))
    found = F.expr(f"filter(more, x -> {likelihood_ratio('x.hit')} > greatest({mean}D, {total}D / (length(x.hit) - 1)))")
    return rows.select("row", "base", F.array_sort(F.concat("base", found)).alias("spans"))
