"""Long passages that occur twice anywhere, by recompression.

Words get 64-bit names. A first round names runs of one word, then each further round splits all
names by one bit of a hash into left and right ones and names every pair (left, right). Names are
fingerprints of what they stand for, so every task gives equal content the same name and no
dictionary has to be shuffled. Beside its name, a symbol carries the span of words that its making
has looked at: wherever a window holds that whole span, the symbol is there too. So two equal
windows hold the same symbols, and choose the same one: the longest, then the smallest hash, then
the leftmost. Per window (consecutive windows mostly agree) only the chosen symbol goes into the
first shuffle, which reveals those found at two places. The windows of shared symbols, and the few
that hold no symbol (inside long runs), go into a second shuffle as 96-bit fingerprints of their
words, which verifies them. The words of windows found twice are then removed.

Symbols and windows are dealt by their hash, texts by the hash of the document; one that repeats
inside a slice of documents is sent on once only, so a passage of a third of all documents sends one
row per slice. Packed arrays travel, one row per slice and receiving group; groups number
`2 * spark.sql.shuffle.partitions`, which should be set so that a group's share of the texts fits
a Python worker. The result depends on 64-bit fingerprints for words and 96-bit ones for windows.

Defined results: words are [^\\x20\\x09-\\x0D]+, unchanged; a null text has none; fewer than `window`
words: nothing is removed; rows that repeat a doc_id are documents of their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from launchcohort.llm.common import byte_texts, mix, shuffle_partitions, slices, word_hashes
from launchcohort.session import written

WINDOW = 35
ROUNDS = 4
FOUND = np.dtype([("name", "<u8"), ("key", "<u8"), ("group", "<u4"), ("start", "<u4"), ("n", "<u4")])
RANGE = np.dtype([("key", "<u8"), ("start", "<u4"), ("n", "<u4")])
MARK = np.dtype([("a", "<u8"), ("b", "<u4"), ("at", "<u4"), ("key", "<u8")])
PLACE = np.dtype([("key", "<u8"), ("at", "<u4")])
U = np.uint64


def named(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return mix(a * U(0x9E3779B97F4A7C15) + mix(b + U(salt)))


def runs(names: np.ndarray, doc: np.ndarray, outer: np.ndarray):
    """Round 0: (names, doc, first word, past the last word, span looked at from, to) of each run."""
    n = len(names)
    first = np.ones(n, bool)
    first[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(first)
    end = np.append(start[1:], n)
    length = end - start
    d = doc[start]
    out = np.where(length > 1, named(names[start], length.astype(U), 1), names[start])
    # A run looks at one word beyond either end; where there is none, at a place outside the document.
    return out, d, start, end, np.maximum(start - 1, outer[d] - 1), np.minimum(end + 1, outer[d + 1] + 1)


def pairs(state, salt: int, outer: np.ndarray):
    """One more round: each left symbol followed by a right one becomes one symbol."""
    names, doc, start, end, lo, hi = state
    n = len(names)
    left = mix(names + U(salt)) & U(1) == 0
    joined = np.zeros(n, bool)
    joined[:-1] = left[:-1] & ~left[1:] & (doc[:-1] == doc[1:])
    after = np.zeros(n, bool)
    after[1:] = joined[:-1]
    keep = np.flatnonzero(~after)
    nxt = np.minimum(keep + 1, n - 1)
    prev = np.maximum(keep - 1, 0)
    j, lf, d = joined[keep], left[keep], doc[keep]
    out = np.where(j, named(names[keep], names[nxt], salt), names[keep])
    end2 = np.where(j, end[nxt], end[keep])
    no_next = (keep == n - 1) | (doc[nxt] != d)
    no_prev = (keep == 0) | (doc[prev] != d)
    # A left symbol that stays alone has looked at the next one, a right one at the one before.
    lo2 = np.where(j | lf, lo[keep], np.where(no_prev, outer[d] - 1, lo[prev]))
    hi2 = np.where(j, hi[nxt], np.where(lf, np.where(no_next, outer[d + 1] + 1, hi[nxt]), hi[keep]))
    return out, d, start[keep], end2, lo2, hi2


def chosen(words: np.ndarray, outer: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS):
    """For the windows of documents laid end to end: their first words, the index of the symbol each has
    chosen (-1: it holds none), and the symbols' names."""
    sizes = np.diff(outer)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(words))
    at = at[outer[doc + 1] - at >= window]
    if not len(at):
        return at, at, words
    state = runs(words, doc, outer)
    for k in range(rounds):
        state = pairs(state, 2 + k, outer)
    names, _, start, end, lo, hi = state
    n = len(words)
    rank = (U(63) - np.minimum(end - start, 63).astype(U)) << U(58) | mix(names + U(77)) >> U(6)
    before = np.cumsum(np.bincount(lo + 1, minlength=n + 3))  # before[s]: symbols whose span begins before s
    within = np.cumsum(np.bincount(hi, minlength=n + 3))
    a, b = before[at], within[at + window] - 1
    best = np.full(len(at), -1)
    some = np.flatnonzero(a <= b)
    width = (b - a + 1)[some]
    level = np.frexp(width.astype(float))[1] - 1
    index = np.arange(len(names))
    for k in range(int(level.max(initial=0)) + 1):
        if k:  # index[i]: leftmost smallest of the 2**k symbols from i on
            h = 1 << (k - 1)
            other = index[np.minimum(np.arange(len(names)) + h, len(names) - 1)]
            index = np.where(rank[other] < rank[index], other, index)
        mine = some[level == k]
        x, y = index[a[mine]], index[b[mine] - (1 << k) + 1]
        best[mine] = np.where((rank[y] < rank[x]) | ((rank[y] == rank[x]) & (y < x)), y, x)
    return at, best, names


def fingerprints(words: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of the words of the windows that begin at `at`: polynomials with odd bases, modulo 2**64."""
    out = []
    for salt, base in ((11, 0xD6E8FEB86659FD93), (13, 0xA0761D6478BD642F)):
        x = mix(words + U(salt))
        h = np.zeros(len(at), np.uint64)
        for k in range(window):
            h = h * U(base) + x[at + k]
        out.append(mix(h))
    return out[0], (out[1] >> U(32)).astype(np.uint32)


def _spread(by: np.ndarray, rows: np.ndarray):
    """The rows of each value of `by`."""
    order = np.argsort(by, kind="stable")
    by, rows = by[order], rows[order]
    cuts = np.flatnonzero(np.diff(by)) + 1
    for part, value in zip(np.split(rows, cuts), by[np.append(0, cuts)] if len(by) else ()):
        yield int(value), part


def _packed(name: str, kind: list[int], group: list[int], blob: list[bytes]):
    return pa.RecordBatch.from_pydict({"kind": pa.array(kind, pa.int32()), name: pa.array(group, pa.int32()), "blob": pa.array(blob, pa.binary())})


def _reveal(groups: int, window: int, rounds: int):
    def run(batches):
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            group = batch.column("group").to_numpy(zero_copy_only=False)
            for i, j in slices(texts):
                words, outer = word_hashes(texts[i:j])
                at, best, names = chosen(words, outer, window, rounds)
                if not len(at):
                    continue
                doc = np.searchsorted(outer, at, side="right") - 1
                cut = np.flatnonzero(np.append(True, (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])))
                found = np.zeros(len(cut), FOUND)
                symbol, d = best[cut], doc[cut]
                found["name"], found["key"], found["group"] = names[symbol], keys[i:j][d], group[i:j][d]
                found["start"], found["n"] = at[cut] - outer[d], np.diff(np.append(cut, len(at)))
                open_ = symbol < 0
                _, inverse, count = np.unique(found["name"], return_inverse=True, return_counts=True)
                here = ~open_ & (count[inverse] > 1)
                # What repeats within the slice needs no other task to be a candidate.
                out = [(-1, g, p) for g, p in _spread(found["group"][open_ | here], found[open_ | here][["key", "start", "n"]].astype(RANGE))]
                one = np.flatnonzero(~open_)
                _, first = np.unique(found["name"][one], return_index=True)
                sent = found[one[first]]
                out += [(b, -1, p) for b, p in _spread((sent["name"] % U(groups)).astype(np.int64), sent)]
                yield _packed("group", [o[0] for o in out], [o[1] for o in out], [o[2].tobytes() for o in out])

    return run


def _shared(part: pa.Table) -> pa.Table:
    rows = np.concatenate([np.frombuffer(b, FOUND) for b in part.column("blob").to_pylist()])
    _, inverse, count = np.unique(rows["name"], return_inverse=True, return_counts=True)
    rows = rows[count[inverse] > 1]
    out = list(_spread(rows["group"].astype(np.int64), rows[["key", "start", "n"]].astype(RANGE)))
    return pa.table({"group": pa.array([g for g, _ in out], pa.int32()), "blob": pa.array([p.tobytes() for _, p in out], pa.binary())})


def _documents(docs: pa.Table):
    texts = byte_texts(docs.column("text").combine_chunks())
    keys = docs.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys, kind="stable")
    return [texts[i] for i in order], keys[order], order


def _expand(ranges: np.ndarray) -> np.ndarray:
    """The places of all windows of the ranges, each once, by key and place."""
    n = ranges["n"].astype(np.int64)
    out = np.zeros(int(n.sum()), PLACE)
    out["key"] = np.repeat(ranges["key"], n)
    out["at"] = np.repeat(ranges["start"], n) + (np.arange(len(out)) - np.repeat(np.cumsum(n) - n, n))
    return np.unique(out)


def _verify(groups: int, window: int):
    def run(docs: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[tuple[int, bool, bytes]] = []
        blobs = candidates.column("blob").to_pylist()
        if docs.num_rows and blobs:
            places = _expand(np.concatenate([np.frombuffer(b, RANGE) for b in blobs]))
            texts, keys, _ = _documents(docs)
            for i, j in slices(texts):
                words, outer = word_hashes(texts[i:j])
                # Equal keys are equal rows: each has the same places.
                first, last = np.searchsorted(places["key"], keys[i:j], "left"), np.searchsorted(places["key"], keys[i:j], "right")
                n = last - first
                take = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                at = places["at"][take].astype(np.int64) + np.repeat(outer[:-1], n)
                mark = np.zeros(len(at), MARK)
                mark["a"], mark["b"] = fingerprints(words, at, window)
                mark["at"], mark["key"] = places["at"][take], np.repeat(keys[i:j], n)
                order = np.lexsort((mark["b"], mark["a"]))
                mark = mark[order]
                new = np.append(True, (mark["a"][1:] != mark["a"][:-1]) | (mark["b"][1:] != mark["b"][:-1]))[:len(mark)]
                again = ~new | np.append(~new[1:], False)[:len(mark)]
                # What repeats within the slice is confirmed already; one of each goes on for the others.
                if again.any():
                    out.append(((int(keys[i]) + i) % groups, True, mark[again][["key", "at"]].astype(PLACE).tobytes()))
                out += [(b, False, p.tobytes()) for b, p in _spread((mark["a"][new] % U(groups)).astype(np.int64), mark[new])]
        group = docs.column("group")[0].as_py() if docs.num_rows else 0
        return pa.table({"bucket": pa.array([o[0] for o in out], pa.int32()), "group": pa.array([group] * len(out), pa.int32()),
                         "sure": pa.array([o[1] for o in out], pa.bool_()), "blob": pa.array([o[2] for o in out], pa.binary())})

    return run


def _confirm(part: pa.Table) -> pa.Table:
    sure, home, packed = (part.column(c).to_pylist() for c in ("sure", "group", "blob"))
    out = [(g, b) for g, s, b in zip(home, sure, packed) if s]
    blobs = [(g, np.frombuffer(b, MARK)) for g, s, b in zip(home, sure, packed) if not s]
    rows = np.concatenate([np.zeros(0, MARK), *(b for _, b in blobs)])
    group = np.repeat(np.array([g for g, _ in blobs], np.int64), [len(b) for _, b in blobs])
    order = np.lexsort((rows["b"], rows["a"]))
    a, b = rows["a"][order], rows["b"][order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    twice = np.zeros(len(rows), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    out += [(g, p.tobytes()) for g, p in _spread(group[twice], rows[twice][["key", "at"]].astype(PLACE))]
    return pa.table({"group": pa.array([g for g, _ in out], pa.int32()), "blob": pa.array([b for _, b in out], pa.binary())})


def _remove(window: int, digest: bool):
    def run(docs: pa.Table, repeated: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"row": docs.column("row"), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()),
                             "kept": pa.array([], pa.string())})
        blobs = [np.frombuffer(b, PLACE) for b in repeated.column("blob").to_pylist()]
        places = np.unique(np.concatenate(blobs)) if blobs else np.zeros(0, PLACE)
        texts, keys, order = _documents(docs)
        first, last = np.searchsorted(places["key"], keys, "left"), np.searchsorted(places["key"], keys, "right")
        n_words, n_removed, kept = [], [], []
        for t, f, l in zip(texts, first.tolist(), last.tolist()):
            words = t.split()
            n_words.append(len(words))
            if l > f:
                edge = np.zeros(len(words) + 1, np.int64)
                at = places["at"][f:l].astype(np.int64)
                edge[at] += 1
                np.add.at(edge, at + window, -1)
                stays = np.cumsum(edge[:-1]) == 0
                words = [w for w, s in zip(words, stays.tolist()) if s]
            n_removed.append(n_words[-1] - len(words))
            out = b" ".join(words)
            kept.append(hashlib.sha256(out).hexdigest() if digest else out.decode())
        return pa.table({"row": docs.column("row").take(pa.array(order)), "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
                    digest: bool = False) -> DataFrame:
    """`row` (a struct of all input columns but the text), n_words, n_removed, and `kept`: the words that
    stay, joined by spaces, or their SHA-256 with `digest`."""
    if window < 4 * (1 << rounds) // 2:
        raise ValueError("the window is too short for so many rounds")
    spark = docs.sparkSession
    groups = 2 * shuffle_partitions(spark)
    key = F.xxhash64(F.col(doc_id), F.col(text))
    group = F.pmod(F.hash(F.col(doc_id), F.xxhash64(F.col(text))), F.lit(groups)).alias("group")
    slim = docs.select(group, key.alias("key"), F.col(text).alias("text"))
    named_ = written(slim.mapInArrow(_reveal(groups, window, rounds), "kind int, group int, blob binary"), "symbols")
    shared = named_.where("kind >= 0").groupBy("kind").applyInArrow(_shared, "group int, blob binary")
    candidates = named_.where("kind < 0").select("group", "blob").unionByName(shared)
    rows = docs.select(group, key.alias("key"), F.col(text).alias("text"), F.struct(*[docs[c] for c in docs.columns if c != text]).alias("row"))
    marks = (rows.groupBy("group").cogroup(candidates.groupBy("group"))
             .applyInArrow(_verify(groups, window), "bucket int, group int, sure boolean, blob binary"))
    repeated = marks.groupBy("bucket").applyInArrow(_confirm, "group int, blob binary")
    out = StructType([StructField("row", rows.schema["row"].dataType), StructField("n_words", LongType()),
                      StructField("n_removed", LongType()), StructField("kept", StringType())])
    return rows.groupBy("group").cogroup(repeated.groupBy("group")).applyInArrow(_remove(window, digest), out)
