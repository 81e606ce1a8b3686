"""Toxicity of texts: disguised words are restored first, then the restored text is scored.

A noisy channel: someone writes a word and disguises it, with digits and signs for letters, blanks
or dots between them, or letters repeated. Each suspicious stretch of a text becomes a lattice of
the letters its characters may stand for (or none, for separators and repeats), and Viterbi decoding
finds the likeliest reading under a character trigram model. The trigram counts are summed over the
letters of all documents; 28 * 28 * 28 sums at most reach the driver. The restored text is scored by
a logistic regression on its words and on beginnings that one, two or three of its words share. It is
fitted to a bounded sample of labelled rows, restored the same way (`MAX_LABELLED`, smallest hashes
first), on the features whose log-odds there are clearly above zero (`MAX_FEATURES`).

Texts are read where they are; only sums per task, labelled ids and word counts are shuffled.

Defined results: null and empty texts get the score of a text without any telling word; a label that
is null says nothing; a document labelled twice counts as toxic if one label says so; labelled rows
that repeat doc_id and text are learned from once; without
labels of both sorts every score is 0. Label, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from launchcohort.llm.common import byte_texts, slices, thin
from launchcohort.session import written

LETTERS = 28  # a-z, all else that can be part of a word, and none
NONE, OTHER = 0, 27
MAX_LABELLED = 20_000
MIN_TOXIC = 4
MIN_ODDS = 1.5
MAX_FEATURES = 4096
BEGINNINGS = (5, 6)  # bytes
THRESHOLD = 0.3

# What a sign may stand for, with the cost of such a disguise.
SIGNS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
SIGN_COST, DROP_COST, REPEAT_COST, BREAK_COST = 1.0, 0.3, 0.3, 0.5

# Stretches that may hide a word: single letters set apart; letters among signs; a letter three times.
SPACED = rb"(?<![0-9A-Za-z\x80-\xff@$])(?:[A-Za-z0-9@$!][ .\-_*]{1,3}){2,}[A-Za-z0-9@$!](?![0-9A-Za-z\x80-\xff@$])"
MIXED = rb"(?<![0-9A-Za-z\x80-\xff@$!|+(])(?=[0-9@$!|+(]*[A-Za-z])(?:[A-Za-z]+[0-9@$!|+(]{1,2}[A-Za-z]|[0-9@$!|+(]{1,2}[A-Za-z])[A-Za-z0-9@$!|+(]*"
DOTTED = rb"(?<![0-9A-Za-z\x80-\xff])[A-Za-z0-9@$]{1,2}(?:[.\-_*][A-Za-z0-9@$]{1,2}){2,}(?![0-9A-Za-z\x80-\xff])"
REPEATED = rb"(?<![A-Za-z\x80-\xff])(?=[A-Za-z]*([A-Za-z])\1\1)[A-Za-z]+"
NOISY = re.compile(b"(?:" + b"|".join((SPACED, DOTTED, MIXED, REPEATED)) + b")")

TO_CLASS = np.full(256, NONE, np.uint8)
TO_CLASS[65:91] = TO_CLASS[97:123] = np.arange(1, 27)
TO_CLASS[128:] = OTHER
# Bytes that are part of a word stay, lower-cased; the others become blanks.
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 or b == 39 else 32 for b in range(256))


def _trigrams(batches):
    total = np.zeros(LETTERS ** 3, np.int64)
    for batch in thin(batches):
        texts = byte_texts(batch.column(0))
        for i, j in slices(texts, 1 << 20):  # some 30 bytes of arrays a byte
            c = TO_CLASS[np.frombuffer(b"  ".join([b"", *texts[i:j], b""]), np.uint8)].astype(np.int32)
            total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS ** 3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})


def letter_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """-log P(c | a, b) at [a, b, c], from all texts, smoothed by P(c | b)."""
    n = np.zeros(LETTERS ** 3)
    for r in docs.select(F.col(text).alias("text")).mapInArrow(_trigrams, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        n[r.at] = r.n
    n = n.reshape(LETTERS, LETTERS, LETTERS)
    two = n.sum(axis=0) + 0.1
    two /= two.sum(axis=1, keepdims=True)
    return -np.log((n + 5 * two[None]) / (n.sum(axis=2, keepdims=True) + 5))


class Restorer:
    """Reads noisy stretches; those met before are remembered, up to a bound."""

    REMEMBERED = 1 << 16

    def __init__(self, cost: np.ndarray):
        self.cost, self.known = cost.tolist(), {}

    def read(self, noisy: bytes) -> bytes:
        got = self.known.get(noisy)
        if got is None:
            if len(self.known) > self.REMEMBERED:
                self.known.clear()
            got = self.known[noisy] = self.decode(noisy)
        return got

    def decode(self, noisy: bytes) -> bytes:
        """The likeliest word behind a stretch. The lattice is walked character by character; a state is
        the last two letters read, and keeps its best reading only."""
        text, cost = noisy.decode("latin-1").lower(), self.cost
        states = {(NONE, NONE): (0.0, None)}
        for k, ch in enumerate(text):
            arcs = [(ord(x) - 96, SIGN_COST) for x in SIGNS.get(ch, "")]
            if "a" <= ch <= "z":
                arcs.append((ord(ch) - 96, 0.0))
            if ch == " ":
                arcs.append((NONE, BREAK_COST))
            # Two equal letters may be right, three are not.
            run = k and ch == text[k - 1] and (text[k - 2:k - 1] == ch or text[k + 1:k + 2] == ch)
            skip = REPEAT_COST if run else DROP_COST if ch in " .-_*" or not arcs else None
            after: dict = {}
            for (a, b), (c, path) in states.items():
                row = cost[a][b]
                for letter, extra in arcs:
                    v = c + extra + row[letter]
                    if v < after.get((b, letter), (math.inf,))[0]:
                        after[b, letter] = v, (path, letter)
                if skip is not None and c + skip < after.get((a, b), (math.inf,))[0]:
                    after[a, b] = c + skip, path
            states = after
        _, path = min((c + cost[a][b][NONE], i, path) for i, ((a, b), (c, path)) in enumerate(states.items()))[::2] if states else (0, None)
        out = []
        while path:
            path, letter = path
            out.append(chr(96 + letter) if letter else " ")
        return "".join(reversed(out)).encode()

    def restore(self, text: bytes) -> bytes:
        return NOISY.sub(lambda m: self.read(m[0]), text)

    def words(self, text: bytes) -> set[bytes]:
        """The words of the restored text."""
        return set(self.restore(text).translate(TO_WORDS).split())

    def features(self, text: bytes) -> set[bytes]:
        """Its words, and beginnings with how many of them (up to three) share it."""
        words = self.words(text)
        out = set(words)
        for k in BEGINNINGS:
            for start, n in Counter([w[:k] for w in words if len(w) > k]).items():
                out.update(b"%s*%d" % (start, m) for m in range(1, min(n, 3) + 1))
        return out


class Telling:
    """Finds the features that a model knows, without making the others."""

    def __init__(self, features: list[bytes]):
        self.place = {f: i for i, f in enumerate(features)}
        self.words = {f for f in features if b"*" not in f}
        self.starts = {k: {f[:-2] for f in features if f[-2:-1] == b"*" and len(f) == k + 2} for k in BEGINNINGS}

    def of(self, words: set[bytes]) -> list[int]:
        out = [self.place[w] for w in words & self.words]
        for k, known in self.starts.items():
            if known:
                for start, n in Counter([s for w in words if (s := w[:k]) in known and len(w) > k]).items():
                    out += [i for m in range(1, min(n, 3) + 1) if (i := self.place.get(b"%s*%d" % (start, m))) is not None]
        return out


def _feature_counts(cost):
    def run(batches):
        toxic, clean = Counter(), Counter()
        reader = Restorer(cost.value)
        for batch in batches:
            for t, y in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist()):
                side = toxic if y else clean
                side.update(reader.features(t))
                side[b""] += 1
        names = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.binary()), "toxic": pa.array([toxic[w] for w in names], pa.int64()), "clean": pa.array([clean[w] for w in names], pa.int64())})

    return run


def _labelled_features(cost, features):
    def run(batches):
        reader, telling = Restorer(cost.value), Telling(features)
        for batch in batches:
            found = [sorted(telling.of(reader.words(t))) for t in byte_texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([int(bool(y)) for y in batch.column(1).to_pylist()], pa.int32()), pa.array(found, pa.list_(pa.int32()))], names=["y", "found"])

    return run


def logistic(found: list[list[int]], y: np.ndarray, n: int, steps: int = 3000, l2: float = 0.1) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated gradient steps; the sum of losses plus l2 / 2 times the weights' squares."""
    flat = np.concatenate([np.asarray(f, np.int64) for f in found] or [np.zeros(0, np.int64)])
    row = np.repeat(np.arange(len(found)), [len(f) for f in found])
    w, last, b, last_b = np.zeros(n), np.zeros(n), 0.0, 0.0
    # Curvature is at most a quarter of the largest column sum times the largest row sum.
    most = max(1, np.bincount(row, minlength=1).max()) + 1
    size = 1 / (0.25 * (np.bincount(flat, minlength=n) + 1) * most + l2)
    size_b = 1 / (0.25 * len(y) * most)
    for k in range(steps):
        v, c = w + k / (k + 3) * (w - last), b + k / (k + 3) * (b - last_b)
        g = 1 / (1 + np.exp(-np.clip(np.bincount(row, v[flat], len(y)) + c, -500, 500))) - y
        last, last_b = w, b
        w, b = v - size * (np.bincount(flat, g[row], n) + l2 * v), c - size_b * g.sum()
    return float(b), w


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, cost, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          max_labelled: int = MAX_LABELLED) -> tuple[float, list[bytes], np.ndarray]:
    """The intercept, the telling features and their weights."""
    known = (labels.select(F.col(doc_id).alias("_id"), F.col(label).alias("_y")).where("_id is not null and _y is not null").where(~held_out(F.col("_id")))
             .groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(max_labelled))
    # Rows that repeat id and text are one; ids may repeat with other texts, so those are bounded as well.
    met = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(known), "_id")
    keys = written(met.select("_id", "_key").distinct(), "labelled-keys")
    if keys.count() > max_labelled:
        keys = keys.orderBy(F.xxhash64("_id", "_key"), "_id", "_key").limit(max_labelled)
    # As many labelled texts as the bound allows; both steps read them from here.
    sample = written(met.join(F.broadcast(keys), ["_id", "_key"]).groupBy("_id", "_key").agg(F.min("_text").alias("_text"), F.first("_y").alias("_y")).select("_text", "_y"), "labelled")
    counted = written(sample.mapInArrow(_feature_counts(cost), "feature binary, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "features")
    n = counted.where(F.length("feature") == 0).first()
    if not n or not n.toxic or not n.clean:
        return -math.inf, [], np.zeros(0)
    odds = F.log((F.col("toxic") + 0.5) / (n.toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n.clean + 1.0))
    # Two standard errors below, it is still well above zero.
    sure = odds - 2 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    telling = (counted.where((F.length("feature") > 0) & (F.col("toxic") >= MIN_TOXIC)).select("feature", sure.alias("sure"))
               .where(F.col("sure") > MIN_ODDS).orderBy(F.desc("sure"), "feature").limit(MAX_FEATURES))
    features = [bytes(r.feature) for r in telling.collect()]
    # Bounded by `max_labelled`; sorted here, so that the sums do not depend on the order of the rows.
    rows = sorted(sample.mapInArrow(_labelled_features(cost, features), "y int, found array<int>").collect(), key=lambda r: (r.y, r.found))
    base, weights = logistic([r.found for r in rows], np.array([r.y for r in rows], float), len(features))
    return base, features, weights


def _score(model):
    def run(batches):
        cost, base, features, weights = model.value
        reader, telling = Restorer(cost), Telling(features)
        for batch in thin(batches):
            out = []
            for t in byte_texts(batch.column(1)):
                z = base + float(weights[telling.of(reader.words(t))].sum()) if features else base
                out.append(1 / (1 + math.exp(-z)) if z > -700 else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["row", "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_labelled: int = MAX_LABELLED,
             with_text: bool = False) -> DataFrame:
    """`row` (a struct of all input columns; but the text, unless `with_text`) and score."""
    context = docs.sparkSession.sparkContext
    cost = letter_model(docs, text)
    model = train(docs, labels, context.broadcast(cost), doc_id, text, label, max_labelled)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if with_text or c != text]).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(_score(context.broadcast((cost, *model))), StructType([StructField("row", rows.schema["row"].dataType), StructField("score", DoubleType())]))
