"""Spelling variants: words one edit apart, and the frequent word that a rare one is a variant of.

Two words of one edit agree up to some place and again after it: with m the length of the shorter one,
common prefix plus common suffix reach the longer length less one. The places are cut into pieces of a
few code points. For every piece a word is keyed by what lies before and behind it, so two words of one
edit share the key of the piece in which their common prefix ends, and only there they are reported:
each pair once, and none is missed.

Rows of a key are laid as padded code-point matrices, one aligned left, one right, and block pairs of
them are compared densely. Words that agree outside a piece are few however large the vocabulary is; where
a key still holds more than `DENSE` words, it is cut further by single places, which leaves at most
one word per letter. Tasks stream rows sorted by key and hold one key's rows at a time.

Counting sends one row per word and slice of texts; links one row per pair and direction; forms are
followed by pointer doubling, and as a form is at least ten times as frequent as its word, five rounds
do for any count of 64 bits.

Defined results: null and empty texts have no words; null ids count as empty strings in the hash;
repeated rows count as often as they occur; a word's form is null without a near word that frequent,
its root then the word itself.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchcohort.llm.common import byte_texts, slices
from launchcohort.session import written

# The letters of a word, its least length and count, and how much more frequent a form is.
RUN = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
DELETE_EVERY = 31

PIECE, PIECES = 3, 16
DENSE, CELLS = 4096, 1 << 22


def _count(least: int):
    """(word, n) of each slice of texts, after the contract's deletions."""
    runs = re.compile(RUN + "{%d,}" % least)

    def run(batches):
        for batch in batches:
            texts, ids = byte_texts(batch.column("text")), batch.column("id").to_pylist()
            for i, j in slices(texts, 16 << 20):
                n: Counter = Counter()
                for k in range(i, j):
                    # bytes.lower() changes A-Z only.
                    start = zlib.crc32(f"{'' if ids[k] is None else ids[k]}:".encode())
                    for word, times in Counter(runs.findall(texts[k].lower().decode())).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % DELETE_EVERY == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least:
                                continue
                        n[word] += times
                yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())], names=["word", "n"])

    return run


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all texts."""
    parts = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text")).mapInArrow(_count(least_length), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def keyed(words: DataFrame, least_length: int) -> DataFrame:
    """(key, t, j, word, n): a word under every piece j, as one of length t and as the longer one of t + 1."""
    wide = f"greatest({PIECE}, bigint(ceil(t / {PIECES}D)))"
    keys = f"""flatten(transform(filter(array(length(word), length(word) - 1), t -> t >= {least_length}),
        t -> transform(sequence(0, int(t div {wide})), j -> struct(
            xxhash64(t, j, substring(word, 1, int(j * {wide})), substring(word, length(word) + 1 - int(greatest(0, t - (j + 1) * {wide})))) as key, t, j))))"""
    return words.select(F.explode(F.expr(keys)).alias("k"), "word", "n").select("k.key", "k.t", "k.j", "word", "n")


def piece(t: int) -> int:
    return max(PIECE, -(-t // PIECES))


def padded(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points aligned left and right, with at least one zero beside every word."""
    def lay(ws):
        return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in ws), np.uint8).reshape(len(ws), width)

    return lay(words), lay([w[::-1] for w in words])


def tile(left, right, length, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a block pair (lines a against lines b, stacked in groups) that are one edit apart: places and common prefix."""
    def common(side):
        differ = side[a][:, :, None, :] != side[b][:, None, :, :]
        differ |= (side[a] == 0)[:, :, None, :]  # a word ends at its padding
        return differ.argmax(axis=3)

    prefix, suffix = common(left), common(right)
    la, lb = length[a][:, :, None], length[b][:, None, :]
    near = (prefix + suffix >= np.maximum(la, lb) - 1) & ((lb - la == 1) | ((lb == la) & (a[:, :, None] != b[:, None, :])))
    g, x, y = np.nonzero(near)
    return a[g, x], b[g, y], prefix[near]


def near_in_groups(words: list[bytes], t: int, j: int, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (x, y) of the words one edit apart within groups of one (t, j); a pair of equal lengths in both directions."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = t + 2
    left, right = padded(words, width)
    length = np.fromiter(map(len, words), np.int64, len(words))
    size, xs, ys = ends - starts, [], []
    for s in np.unique(size).tolist():
        chosen = starts[size == s]
        if s * s * width <= CELLS:  # stacks of small groups of one size
            step = max(1, CELLS // (s * s * width))
            blocks = [(lines := chosen[k:k + step, None] + np.arange(s), lines) for k in range(0, len(chosen), step)]
        else:
            side = max(1, int((CELLS / width) ** 0.5))
            blocks = [(np.arange(p, min(p + side, c + s))[None], np.arange(q, min(q + side, c + s))[None])
                      for c in chosen.tolist() for p in range(c, c + s, side) for q in range(c, c + s, side)]
        for a, b in blocks:
            x, y, prefix = tile(left, right, length, a, b)
            # The pair belongs to this piece, and pairs of two longer words to the next length.
            mine = (prefix // piece(t) == j) & (length[x] == t)
            xs.append(x[mine])
            ys.append(y[mine])
    return np.concatenate(xs), np.concatenate(ys)


def split_by_place(words: list[bytes], t: int, j: int):
    """A large group cut by every single place of its piece: lines that agree before and behind that place."""
    for p in range(j * piece(t), min((j + 1) * piece(t), t + 1)):
        groups: dict[tuple[bytes, bytes], list[int]] = {}
        for i, w in enumerate(words):
            groups.setdefault((w[:p], w[len(w) - max(0, t - p - 1):] if t - p - 1 > 0 else b""), []).append(i)
        for lines in groups.values():
            if len(lines) > 1:
                yield p, lines


def _near(dense: int):
    """Rows sorted by key: (word, n_near, other, other_n), the other one only where it is frequent enough for a form."""
    def done(rows: pa.Table):
        key, t, j, n = (rows.column(c).to_numpy() for c in ("key", "t", "j", "n"))
        words = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
        cut = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (t[1:] != t[:-1]) | (j[1:] != j[:-1])))
        ends = np.append(cut[1:], len(words))
        many = ends - cut > 1
        cut, ends = cut[many], ends[many]
        out = []
        for kind in sorted(set(zip(t[cut].tolist(), j[cut].tolist()))):
            mine = (t[cut] == kind[0]) & (j[cut] == kind[1])
            small = mine & (ends - cut <= dense)
            lines = np.concatenate([np.zeros(0, np.int64), *[np.arange(a, b) for a, b in zip(cut[small], ends[small])]])
            size = (ends - cut)[small]
            stop = np.cumsum(size)
            x, y = near_in_groups([words[k] for k in lines], *kind, stop - size, stop)
            out.append((lines[x], lines[y]))
            for a, b in zip(cut[mine & ~small].tolist(), ends[mine & ~small].tolist()):
                for p, part in split_by_place(words[a:b], *kind):
                    left = [words[a + k] for k in part]
                    x, y = near_in_groups(left, *kind, np.array([0]), np.array([len(left)]))
                    # Of the places only that where the common prefix ends reports the pair.
                    at = np.array(part, np.int64) + a
                    keep = [_prefix(left[i], left[k]) == p for i, k in zip(x, y)]
                    out.append((at[x[keep]], at[y[keep]]))
        if not out:
            return None
        x, y = (np.concatenate([o[k] for o in out]) for k in (0, 1))
        short = np.fromiter((len(words[a]) < len(words[b]) for a, b in zip(x, y)), bool, len(x))
        x, y = np.concatenate([x, y[short]]), np.concatenate([y, x[short]])
        frequent = n[y] >= TIMES * n[x]
        pick = rows.column("word").combine_chunks()
        return pa.RecordBatch.from_arrays(
            [pick.take(pa.array(x)), pa.array(np.ones(len(x), np.int64)), pick.take(pa.array(y, mask=~frequent)), pa.array(n[y], mask=~frequent)],
            names=["word", "n_near", "other", "other_n"])

    def run(batches):
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            key = held.column("key").to_numpy()
            stop = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last key may go on in the next batch
            if stop:
                if (found := done(held.slice(0, stop))) is not None:
                    yield found
                held = held.slice(stop)
        if held is not None and held.num_rows and (found := done(held)) is not None:
            yield found

    return run


def _prefix(a: bytes, b: bytes) -> int:
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                      dense: int = DENSE) -> DataFrame:
    """(word, n, n_near, form, form_n, root), one row per word."""
    words = written(word_counts(docs, doc_id, text, least_length, least_count), "words")
    links = (keyed(words, least_length).repartition("key").sortWithinPartitions("key", "t", "j")
             .mapInArrow(_near(dense), "word string, n_near long, other string, other_n long"))
    # The most frequent other word; of equal ones the first in code-point order, which is that of UTF-8.
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form"))))
    near = links.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    found = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.m")).alias("form_n")), "variants")
    step = written(found.where("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        # Each round doubles how far a root has been followed.
        next_ = step.select(F.col("word").alias("at"), F.col("root").alias("further"))
        far = step.join(next_, F.col("root") == F.col("at"), "left")
        moved = written(far.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        step = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return found.join(step, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
