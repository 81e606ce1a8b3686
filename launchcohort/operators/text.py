"""Term tables, TF-IDF, Naive Bayes and sentiment as joins and sums over (id, term) rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from launchcohort.functions.scalars import SPACES, sentences
from launchcohort.functions.text import tokens
from launchcohort.operators.lookup import lookup
from launchcohort.session import written

# Vocabulary bounds and Naive-Bayes smoothing.
MIN_DF, MAX_DF, ALPHA = 10, 0.35, 1.0


def term_counts(df: DataFrame, text: str = "text", stop_words: tuple[str, ...] | None = None,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, term, tf). Ids are unique, so terms are counted within their row and nothing is shuffled."""
    ordered = df.select("id", *keep, F.array_sort(tokens(F.col(text), stop_words)).alias("_tokens"))
    # Where a run of equal tokens ends, counted from 1.
    last = F.filter(F.sequence(F.lit(1), F.size("_tokens")), lambda i: ~F.get("_tokens", i - 1).eqNullSafe(F.get("_tokens", i)))
    ends = ordered.withColumn("_ends", F.when(F.size("_tokens") > 0, last))
    runs = F.transform("_ends", lambda end, k: F.struct(
        F.get("_tokens", end - 1).alias("term"), (end - F.coalesce(F.get("_ends", k - 1), F.lit(0))).cast("long").alias("tf")))
    # The outer form: the plain one makes Spark split every text twice, to drop empty ones first.
    terms = ends.select("id", *keep, F.explode_outer(runs).alias("_run")).select("id", *keep, "_run.term", "_run.tf")
    return terms.filter(F.col("term").isNotNull())


def document_frequency(df: DataFrame, text: str = "text", stop_words: tuple[str, ...] | None = None) -> DataFrame:
    """(term, df): in how many texts each term is. Repeats go within the row, so only sums are shuffled."""
    terms = df.select(F.explode_outer(F.array_distinct(tokens(F.col(text), stop_words))).alias("term"))
    return terms.filter(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("df"))


def vocabulary(df: DataFrame, text: str = "text", min_df: int = MIN_DF, max_df: float = MAX_DF,
               stop_words: tuple[str, ...] | None = None) -> DataFrame:
    """(term, df) of the terms in at least `min_df` texts and at most `max_df` of them."""
    n_docs = df.agg(F.count("*").alias("n")).scalar()
    return document_frequency(df, text, stop_words).filter(
        (F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))


def idf(df: Column, n_docs: int) -> Column:
    return F.log((F.lit(1.0) + n_docs) / (df + F.lit(1.0))) + F.lit(1.0)


def weights(counts: DataFrame, terms: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(id, term, w): sublinear TF-IDF of unit length per id. `terms` has (term, df, idf)."""
    met = lookup(counts, terms.select("term", "df", "idf", *extra), "term", rows_of="df")
    raw = met.filter(F.col("idf").isNotNull()).withColumn("w", (F.lit(1.0) + F.log("tf")) * F.col("idf"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return raw.withColumn("w", F.col("w") / length).drop("tf", "df", "idf")


@dataclass
class TextModel:
    """Fitted vocabulary with idf, and per term what Naive Bayes adds to the log odds.

    `terms` has (term, df, idf, odds, odds0..): `odds` from all rows, `odds<f>` without fold f.
    `train` is the written TF-IDF table (id, y, fold, term, w) of the training rows.
    """

    terms: DataFrame
    n_docs: int
    prior: float
    oof_priors: list[float]
    text: str = "text"
    stop_words: tuple[str, ...] | None = None
    train: DataFrame | None = None

    def tfidf(self, df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
        return weights(term_counts(df, self.text, self.stop_words), self.terms, extra)

    def probability(self, rows: DataFrame, evidence: DataFrame, prior: Column) -> DataFrame:
        """(id, nb_prob) for `rows`; texts without known terms get the class prior."""
        log_odds = prior + F.coalesce("evidence", F.lit(0.0))
        return rows.join(evidence, "id", "left").select(
            "id", (F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds))).alias("nb_prob"))

    def nb_probability(self, df: DataFrame) -> DataFrame:
        """For new rows: Naive Bayes of all training rows."""
        found = self.tfidf(df, ("odds",)).groupBy("id").agg(F.sum(F.col("w") * F.col("odds")).alias("evidence"))
        return self.probability(df.select("id"), found, F.lit(self.prior))

    def out_of_fold_probability(self, df: DataFrame) -> DataFrame:
        """For the training rows with their `fold`: Naive Bayes of the other folds' labels only."""
        names = [f"odds{f}" for f in range(len(self.oof_priors))]

        def of_fold(values: list[Column]) -> Column:
            return F.element_at(F.array(*values), F.col("fold") + 1)

        met = lookup(self.train, self.terms.select("term", "df", *names), "term", rows_of="df")
        found = met.groupBy("id").agg(F.sum(F.col("w") * of_fold([F.col(c) for c in names])).alias("evidence"))
        return self.probability(df.select("id", "fold"), found, of_fold([F.lit(p) for p in self.oof_priors]))


def fit_vocabulary(df: DataFrame, text: str = "text", min_df: int = MIN_DF, max_df: float = MAX_DF,
                   stop_words: tuple[str, ...] | None = None) -> tuple[DataFrame, int]:
    """The written (term, df, idf) table of all texts, and their number.

    Terms in too many texts stay in it, without idf: a lookup then knows them as hot terms.
    """
    n_docs = df.count()
    found = document_frequency(df, text, stop_words).filter(F.col("df") >= min_df)
    known = F.when(F.col("df") <= max_df * n_docs, idf(F.col("df"), n_docs))
    return written(found.withColumn("idf", known), "vocabulary"), n_docs


def _log_ratio(one: float, zero: float) -> float:
    """Log odds of the classes; without rows of a class the other is certain."""
    if not one or not zero:
        return math.inf if one else -math.inf
    return math.log(one / zero)


def fit_text(df: DataFrame, text: str = "text", folds: int = 5, alpha: float = ALPHA,
             min_df: int = MIN_DF, max_df: float = MAX_DF,
             stop_words: tuple[str, ...] | None = None) -> TextModel:
    """TF-IDF on all texts and multinomial Naive Bayes on it, with and without each fold.

    `df` has id, text, y and fold. The weights are summed once per (term, class, fold); what the
    other folds hold is the total less the own fold.
    """
    vocab, n_docs = fit_vocabulary(df, text, min_df, max_df, stop_words)
    weighed = written(weights(term_counts(df, text, stop_words, ("y", "fold")), vocab), "tfidf")
    cells = [(c, f) for c in (0, 1) for f in range(folds)]
    sums = written(weighed.groupBy("term").agg(*[
        F.coalesce(F.sum(F.when((F.col("y") == c) & (F.col("fold") == f), F.col("w"))), F.lit(0.0)).alias(f"w{c}_{f}")
        for c, f in cells
    ]), "class-weights")
    v = vocab.filter(F.col("idf").isNotNull()).count()
    mass = sums.agg(*[F.coalesce(F.sum(f"w{c}_{f}"), F.lit(0.0)).alias(f"w{c}_{f}") for c, f in cells]).first()
    rows = df.groupBy("y", "fold").agg(F.count("*").alias("n")).toPandas()

    def n_rows(c: int, without: int | None) -> int:
        return int(rows.loc[(rows["y"] == c) & (rows["fold"] != without), "n"].sum())

    def log_share(c: int, without: int | None) -> Column:
        used = [f for f in range(folds) if f != without]
        term_mass = sum((F.col(f"w{c}_{f}") for f in used), F.lit(0.0))
        return F.log(term_mass + alpha) - math.log(sum(mass[f"w{c}_{f}"] for f in used) + alpha * v)

    odds = {"odds": log_share(1, None) - log_share(0, None)}
    odds |= {f"odds{f}": log_share(1, f) - log_share(0, f) for f in range(folds)}
    terms = vocab.join(sums, "term", "left").select("term", "df", "idf", *[c.alias(n) for n, c in odds.items()])
    return TextModel(
        written(terms, "terms"), n_docs, _log_ratio(n_rows(1, None), n_rows(0, None)),
        [_log_ratio(n_rows(1, f), n_rows(0, f)) for f in range(folds)], text, stop_words, weighed,
    )


# Fixed values of the public rule set for lexicon sentiment: how far a negation or booster reaches,
# what it does there, and how many marks count.
NEGATION = -0.74
DAMPING = (1.0, 0.95, 0.9)
BOOST = 0.293
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
BANG, MAX_BANGS = 0.292, 4
ASK, MAX_ASKS, MANY_ASKS = 0.18, 3, 0.96
ALPHA_SCORE = 15.0
NEGATORS = (
    "aint", "ain't", "arent", "aren't", "cannot", "cant", "can't", "couldnt", "couldn't", "didnt",
    "didn't", "doesnt", "doesn't", "dont", "don't", "hadnt", "hadn't", "hasnt", "hasn't", "havent",
    "haven't", "isnt", "isn't", "neither", "never", "none", "nope", "nor", "not", "nothing",
    "nowhere", "rarely", "seldom", "shouldnt", "shouldn't", "wasnt", "wasn't", "werent", "weren't",
    "without", "wont", "won't", "wouldnt", "wouldn't",
)
BOOSTERS = {
    "absolutely": BOOST, "amazingly": BOOST, "completely": BOOST, "considerably": BOOST,
    "deeply": BOOST, "enormously": BOOST, "entirely": BOOST, "especially": BOOST,
    "extremely": BOOST, "greatly": BOOST, "highly": BOOST, "hugely": BOOST, "incredibly": BOOST,
    "more": BOOST, "most": BOOST, "particularly": BOOST, "quite": BOOST, "really": BOOST,
    "so": BOOST, "totally": BOOST, "very": BOOST,
    "almost": -BOOST, "barely": -BOOST, "hardly": -BOOST, "less": -BOOST, "little": -BOOST,
    "marginally": -BOOST, "occasionally": -BOOST, "partly": -BOOST, "scarcely": -BOOST,
    "slightly": -BOOST, "somewhat": -BOOST,
}
# Punctuation and symbols at the edges of words.
EDGES = rf"(^|(?<={SPACES}))[\p{{P}}\p{{S}}]+|[\p{{P}}\p{{S}}]+(?={SPACES}|$)"


def marks(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def emphasis(bangs: Column, asks: Column) -> Column:
    many = F.when(asks > MAX_ASKS, F.lit(MANY_ASKS)).otherwise(asks * F.lit(ASK))
    return F.least(bangs, F.lit(MAX_BANGS)) * F.lit(BANG) + F.when(asks > 1, many).otherwise(F.lit(0.0))


def compound(total: Column, stress: Column) -> Column:
    """Sum of valences, moved away from zero by `stress`, mapped to (-1, 1)."""
    moved = total + F.signum(total) * stress
    return moved / F.sqrt(moved * moved + ALPHA_SCORE)


def rules_table(lexicon: DataFrame, boosters: dict[str, float], negators: tuple[str, ...]) -> DataFrame:
    """The written (term, valence, shift, turn) table of every word that counts; 'but' is one."""
    names = sorted({*boosters, *negators, "but"})
    rows = [(t, float(boosters.get(t, 0.0)), NEGATION if t in negators else 1.0) for t in names]
    others = lexicon.sparkSession.createDataFrame(rows, "term string, shift double, turn double")
    # A word of the lexicon is judged by its valence alone.
    plain = F.col("valence").isNull()
    return written(lexicon.select("term", "valence").join(others, "term", "full").select(
        "term", "valence", F.when(plain, F.col("shift")).otherwise(0.0).alias("shift"),
        F.when(plain, F.col("turn")).otherwise(1.0).alias("turn")), "rules")


def sentiment(df: DataFrame, lexicon: DataFrame, text: str = "text",
              boosters: dict[str, float] | None = None, negators: tuple[str, ...] = NEGATORS) -> DataFrame:
    """(id, sent_compound, sent_mean_sentence) from a lexicon (term, valence).

    The sentences are spread by text once; all the rest happens within a text. Only words with a
    rule go on: at most three of them can lie within the reach of a word, so looking back over
    three such words sees all there are.
    """
    rules = rules_table(lexicon, BOOSTERS if boosters is None else boosters, negators)

    # What is said of a whole text or sentence is worked out before it is taken apart. The outer
    # explodes keep Spark from splitting every text twice, to drop empty ones first.
    whole = df.select("id", emphasis(marks(F.col(text), "!"), marks(F.col(text), "?")).alias("stress"),
                      F.size(sentences(F.col(text))).alias("n_sentences"), sentences(F.col(text)).alias("sentences"))
    parts = whole.select("id", "stress", "n_sentences", F.posexplode_outer("sentences").alias("part", "sentence"))
    plain = F.lower(F.regexp_replace("sentence", EDGES, ""))
    split = parts.select("id", "stress", "n_sentences", "part",
                         emphasis(marks(F.col("sentence"), "!"), marks(F.col("sentence"), "?")).alias("part_stress"),
                         F.filter(F.split(plain, f"{SPACES}+"), lambda w: w != "").alias("words"))
    earlier = Window.partitionBy("id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = split.withColumn("before", F.coalesce(F.sum(F.size("words")).over(earlier), F.lit(0)))
    placed = offset.select("id", "stress", "n_sentences", "part", "part_stress", "before",
                           F.posexplode_outer("words").alias("place", "term")).withColumn("at", F.col("before") + F.col("place"))
    known = lookup(placed.drop("before"), rules, "term").filter(
        F.col("shift").isNotNull())
    order = Window.partitionBy("id").orderBy("at")
    back = range(1, len(DAMPING) + 1)
    but = F.col("term") == "but"
    seen = known.withColumns({
        **{f"{c}_{d}": F.lag(c, d).over(order) for c in ("shift", "turn", "part", "at") for d in back},
        "but_at": F.min(F.when(but, F.col("at"))).over(Window.partitionBy("id")),
        "but_place": F.min(F.when(but, F.col("place"))).over(Window.partitionBy("id", "part")),
    }).filter(F.col("valence").isNotNull())

    def scored(same_part: bool) -> Column:
        v = F.col("valence")
        for d in back:
            # The word `d` places before, if it has a rule, is one of the three last seen.
            here = [(F.col("at") - F.col(f"at_{k}") == d) & ((F.col(f"part_{k}") == F.col("part")) if same_part else F.lit(True))
                    for k in back]
            shift = F.coalesce(*[F.when(h, F.col(f"shift_{k}")) for h, k in zip(here, back)], F.lit(0.0))
            turn = F.coalesce(*[F.when(h, F.col(f"turn_{k}")) for h, k in zip(here, back)], F.lit(1.0))
            v = (v + F.signum("valence") * shift * DAMPING[d - 1]) * turn
        at, split = (F.col("place"), F.col("but_place")) if same_part else (F.col("at"), F.col("but_at"))
        return v * F.when(at < split, BEFORE_BUT).when(at > split, AFTER_BUT).otherwise(1.0)

    per_part = seen.groupBy("id", "part").agg(
        F.first("stress").alias("stress"), F.first("n_sentences").alias("n_sentences"),
        F.first("part_stress").alias("part_stress"),
        F.sum(scored(False)).alias("whole"), F.sum(scored(True)).alias("alone"))
    per_text = per_part.groupBy("id").agg(
        compound(F.sum("whole"), F.first("stress")).alias("sent_compound"),
        (F.sum(compound(F.col("alone"), F.col("part_stress"))) / F.first("n_sentences")).alias("sent_mean_sentence"))
    filled = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("sent_compound", "sent_mean_sentence")}
    return df.select("id").join(per_text, "id", "left").withColumns(filled)
