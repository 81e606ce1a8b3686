"""Quality rules: statistics of a text, and a learned decision list over them as one conditional expression.

Statistics come from built-in functions on the text where it lies. The list is learned by sequential
covering: a rule grows by the threshold condition of the highest information gain until it covers no
good text, is cut back on rows held apart for that, and is kept while it is right there; the texts it
covers leave, and the next rule is grown. Every step counts labelled rows per statistic, range and
label in one aggregation, so the driver sees counts, never rows. The rules are emitted as
`CASE WHEN a > x AND b <= y THEN false ... ELSE true END`.

Thresholds lie at quantiles of each statistic among the good and among the bad rows. Of the labelled rows the
`MAX_LABELLED` with the smallest hashes serve (one row per id); statistics are of all texts.

Defined results: null and empty texts have no words, all counts 0; base rules come first, and texts
that fail them are not learned from; ids with labels of both kinds, null ids and null labels are not
learned from; an id with several texts is learned from as the one of the smallest hash; without labels
of both kinds no rule is learned and the base rules decide. Shares are per word or code point, 0 where
there is none. Columns of `docs` may have any names; those but the text come back in `row`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from launchcohort.session import written

# White space, symbols and limits of the base rules.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED = 50, 50

MAX_LABELLED, CUTS = 50_000, 32
MAX_RULES, MAX_CONDITIONS = 16, 4
LEAST_RIGHT, LEAST_ROWS = 0.9, 3
STATISTICS = ("n_words", "chars_per_word", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share", "upper_share",
              "digit_share", "mark_share", "words_per_line", "dot_share")


PLACES = 20  # bits of a window's place


def covered(places: str) -> str:
    """SQL for how many words windows of three at the sorted `places` hold; what the next window holds too counts once."""
    return f"bigint(aggregate({places}, struct(0 as n, -3 as last), (s, i) -> struct(s.n + int(least(3, i - s.last)) as n, int(i) as last), s -> s.n))"


def sorted_windows() -> str:
    """SQL for the places of the repeated windows of `words`, by sorting the windows themselves."""
    window = "struct(words[i] as a, words[i + 1] as b, words[i + 2] as c)"
    return f"""aggregate(array(sort_array(transform(sequence(0, n_words - 3), i -> struct({window} as w, i)))), cast(array() as array<int>),
        (_, s) -> sort_array(transform(filter(s, (x, k) -> (k > 0 and x.w = get(s, k - 1).w) or (k < size(s) - 1 and x.w = get(s, k + 1).w)), x -> x.i)))"""


def with_repeated_words(rows: DataFrame) -> DataFrame:
    """Adds how many words of the array `words` lie in windows of three that are found twice or more.

    Windows are told apart by 44 bits of their hash, sorted together with their place in one number. Neighbours
    that agree are compared word for word; in a text where two differ, and in one of more than 2**20 windows, the
    windows themselves are sorted. So the count is exact.
    """
    low = (1 << PLACES) - 1
    rows = rows.withColumn("h", F.expr("if(n_words < 4, cast(array() as array<bigint>), transform(sequence(0, n_words - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])))"))
    rows = rows.withColumn("h", F.expr("if(size(array_distinct(h)) < size(h), h, cast(array() as array<bigint>))"))
    rows = rows.withColumn("s", F.expr(f"sort_array(transform(h, (x, i) -> (x & {~low}L) | (i & {low})))"))
    same = f"coalesce(shiftright(x, {PLACES}) = shiftright(get(s, k {{}} 1), {PLACES}), false)"
    rows = rows.withColumn("met", F.expr(f"filter(s, (x, k) -> {same.format('-')} or {same.format('+')})"))
    differ = " or ".join(f"words[int(met[k] & {low}) + {d}] != words[int(met[k - 1] & {low}) + {d}]" for d in range(3))
    rows = rows.withColumn("unsure", F.expr(f"""size(h) > {low + 1} or (size(met) > 1 and exists(sequence(1, greatest(1, size(met) - 1)),
        k -> shiftright(met[k], {PLACES}) = shiftright(met[k - 1], {PLACES}) and ({differ})))"""))
    rows = rows.withColumn("places", F.expr(f"sort_array(transform(met, x -> x & {low}))"))
    return rows.withColumn("n_repeat_words", F.expr(f"case when size(h) = 0 then 0L when unsure then {covered(sorted_windows())} else {covered('places')} end"))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`row` (a struct of all columns but the text), the counts, `base_failed`, and `stats`, a struct of numbers; a written table."""
    t = F.coalesce(F.col(text), F.lit(""))
    kept = [docs[c] for c in docs.columns if c != text]
    rows = docs.select((F.struct(*kept) if kept else F.struct(F.lit(None).alias("none"))).alias("row"), t.alias("t"), F.trim(t, F.lit(SPACE)).alias("core"))
    rows = rows.select("row", "t", F.when(F.col("core") == "", F.array().cast("array<string>")).otherwise(F.split("core", f"[{SPACE}]+", -1)).alias("words"),
                       F.filter(F.split("t", "\n", -1), lambda x: F.trim(x, F.lit(SPACE)) != "").alias("lines"))
    rows = with_repeated_words(rows.withColumn("n_words", F.size("words"))).select(
        "row", F.col("n_words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", F.size(F.array_distinct("words")).alias("distinct"), F.size("lines").alias("lines"),
        F.regexp_count("t", F.lit("[A-ZÀ-Þ]")).alias("upper"), F.regexp_count("t", F.lit("[0-9]")).alias("digits"),
        F.regexp_count("t", F.lit("[!?]")).alias("marks"), F.regexp_count("t", F.lit("[.]")).alias("dots"))

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    values = (F.col("n_words").cast("double"), share("word_chars", "n_words"), share("n_symbols", "n_words"), share("n_dup_lines", "lines"), share("n_repeat_words", "n_words"),
              share("distinct", "n_words"), share("upper", "word_chars"), share("digits", "word_chars"), share("marks", "n_words"), share("n_words", "lines"), share("dots", "n_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = rows.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                      F.struct(*[v.alias(k) for k, v in zip(STATISTICS, values)]).alias("stats"))
    # Written, as a filter pushed below these columns would repeat what they are made of many times over.
    return written(out, "statistics")


def labelled_rows(stats: DataFrame, labels: DataFrame, doc_id: str, label: str, max_labelled: int) -> DataFrame:
    """(stats, bad, grow): labelled rows that pass the base rules, two thirds of them to grow rules on."""
    ids = stats.where(~F.col("base_failed")).select(F.col(f"row.{doc_id}").alias("id"), "stats")
    known = (labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("id")).agg(F.min(label).alias("least"), F.max(label).alias("most"))
             .where("least = most and id is not null").select("id", (F.col("least") == 0).alias("bad")))
    key = F.xxhash64("id", F.lit(12))
    # The limit is taken from the sorted hashes, each task giving at most so many.
    few = known.join(ids.select("id").distinct(), "id", "left_semi").select("id", "bad", key.alias("key")).orderBy("key").limit(max_labelled)
    return (ids.join(F.broadcast(few), "id").groupBy("id").agg(F.min_by("stats", F.xxhash64("stats")).alias("stats"), F.first("bad").alias("bad"), F.first("key").alias("key"))
            .select("stats", "bad", (F.pmod("key", F.lit(3)) != 0).alias("grow")))


def thresholds(labelled: DataFrame, cuts: int = CUTS) -> dict[str, list[float]]:
    """Per statistic the distinct quantiles of the good and of the bad rows."""
    at = [(k + 0.5) / cuts for k in range(cuts)]
    found = labelled.groupBy("bad").agg(*[F.percentile_approx(f"stats.{s}", [0.0, *at, 1.0], 10_000).alias(s) for s in STATISTICS]).collect()
    return {s: sorted({float(v) for r in found for v in r[s]}) for s in STATISTICS}


Condition = tuple[str, bool, int]  # a statistic, whether above the cut, the cut's place


def gain(p: int, n: int, bad: int, good: int) -> float:
    """How much surer a condition that keeps p bad and n good rows makes of a bad one, times p."""
    return p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good))) if p else float("-inf")


def right(p: int, n: int) -> float:
    return (p + 1) / (p + n + 2)


def learn(labelled: DataFrame, max_rules: int = MAX_RULES, max_conditions: int = MAX_CONDITIONS, cuts: int = CUTS,
          least_right: float = LEAST_RIGHT, least_rows: int = LEAST_ROWS) -> list[list[tuple[str, str, float]]]:
    """Ordered rules for bad texts; each is a conjunction of (statistic, '>' or '<=', threshold)."""
    at = thresholds(labelled, cuts)
    if not all(at.values()):
        return []
    # The place of a value among the thresholds, once for all steps: how many lie below it.
    places = [F.expr(f"size(filter(array({', '.join(f'{c!r}D' for c in at[s])}), c -> c < stats.{s}))").alias(s) for s in STATISTICS]
    binned = written(labelled.select("bad", "grow", *places), "binned")

    def holds(c: Condition) -> Column:
        return F.col(c[0]) > c[2] if c[1] else F.col(c[0]) <= c[2]

    def all_of(rule: list[Condition]) -> Column:
        out = F.lit(True)
        for c in rule:
            out = out & holds(c)
        return out

    rules: list[list[Condition]] = []
    left = F.lit(True)
    while len(rules) < max_rules:
        rule: list[Condition] = []
        while len(rule) < max_conditions:
            pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(s).alias("place")) for s in STATISTICS]))
            counts = binned.where(F.col("grow") & left & all_of(rule)).select("bad", pairs.alias("x")).groupBy("x.s", "x.place", "bad").count().collect()
            n: dict = {(r["s"], r["place"], r["bad"]): r["count"] for r in counts}
            bad, good = (sum(v for (s, _, b), v in n.items() if s == STATISTICS[0] and b == k) for k in (True, False))
            if bad < least_rows or not good:
                break
            best, most = [], 1e-9  # the conditions of the highest gain
            for s in STATISTICS:
                p = q = 0
                for k in range(len(at[s])):
                    p, q = p + n.get((s, k, True), 0), q + n.get((s, k, False), 0)
                    for above, x, y in ((False, p, q), (True, bad - p, good - q)):
                        g = gain(x, y, bad, good) if x >= least_rows else 0.0
                        if g > most * (1 + 1e-12):
                            best, most = [], g
                        if abs(g - most) <= 1e-12 * most and g > 1e-9:
                            best.append((s, above, k))
            if not best:
                break
            # Of cuts between the same rows the middle one, as far from the good as from the bad.
            ties = [c for c in best if c[:2] == best[0][:2]]
            rule.append(ties[len(ties) // 2])
        if not rule:
            break
        # What each shortened form does on the rows held apart, in one pass.
        forms = [rule[:k + 1] for k in range(len(rule))]
        held = binned.where(~F.col("grow") & left).agg(*[F.count_if(all_of(f) & (F.col("bad") if b else ~F.col("bad"))).alias(f"{b}{k}") for k, f in enumerate(forms) for b in (1, 0)]).first()
        score = [right(held[f"1{k}"], held[f"0{k}"]) for k in range(len(forms))]
        k = max(range(len(forms)), key=lambda i: (score[i], -i))
        p, q = held[f"1{k}"], held[f"0{k}"]
        if p < least_rows or p < least_right * (p + q):
            break
        rules.append(forms[k])
        left = left & ~all_of(forms[k])
    # The threshold of place k is the k-th: more than k of them lie below a value just if it is above.
    return [[(s, ">" if above else "<=", at[s][k]) for s, above, k in rule] for rule in rules]


def as_sql(rules: list[list[tuple[str, str, float]]], stats: str = "stats") -> str:
    """The list as an ordered conditional expression: whether a text is kept."""
    when = " ".join(f"WHEN {' AND '.join(f'{stats}.{s} {sign} {value!r}D' for s, sign, value in rule)} THEN false" for rule in rules)
    return f"CASE {when} ELSE true END" if rules else "true"


def quality(docs: DataFrame, labels: DataFrame | None, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
            max_labelled: int = MAX_LABELLED, rules: list | None = None) -> DataFrame:
    """`row`, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, stats and kept.

    Rules are learned from `labels` (`doc_id`, `label`; 0 is bad), or given.
    """
    stats = statistics(docs, text)
    if rules is None:
        rules = learn(written(labelled_rows(stats, labels, doc_id, label, max_labelled), "labelled-statistics"))
    return stats.withColumn("kept", ~F.col("base_failed") & F.expr(as_sql(rules)))
