"""Passages of documents that copy a benchmark item, also when edited.

An alignment (Smith-Waterman on words) is reported when it reaches `threshold` of the item's own score,
so it matches at least that share of the item's words, at places of the document that lie in a window
of bounded length. Of an item that needs `k` matches, the `k - SEEDS` most frequent words can all be
matched and still `SEEDS` of the others are: those others are its seeds, and every window
that holds `SEEDS` of them, and enough of the item's words at all, is aligned in full. This is a bound,
not a guess: how often a word occurs decides only what serves as seed, never what is found.

Documents stay in their tasks: nothing of them is shuffled but found pairs, and equal passages that a
task meets again are aligned once. Items are broadcast with their seeds, in groups of about
`ITEM_WORDS` words; each further group is another pass over the documents.

Defined results: words are runs of letters, digits and bytes beyond ASCII, A-Z lower-cased; null texts
have none; items shorter than `min_words` are found where all their words stand in a row, items
without words nowhere; items of equal words are reported each; of equally good alignments the one that ends first counts; rows that repeat
doc_id and text are one document.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchcohort.llm.common import byte_texts, in_small_batches, slices, thin, word_hashes
from launchcohort.session import written

MIN_WORDS = 8
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
SEEDS = 4
# What is held at once: words of items, hits of seeds, cells of a step of alignments, passages of known scores.
ITEM_WORDS = 1 << 20
HITS = 1 << 19
CELLS = 1 << 17
KNOWN = 1 << 16

WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256))


def align(items: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each item (a row) with its passage: the best local alignment's score, and where it first ends (exclusive)."""
    n, steps = len(items), np.arange(passages.shape[1] + 1, dtype=np.int32)
    row, best, end = np.zeros((n, len(steps)), np.int32), np.zeros(n, np.int32), np.zeros(n, np.int64)
    for w in items.T:
        new = np.zeros_like(row)
        new[:, 1:] = np.where(passages == w[:, None], np.int32(MATCH), np.int32(MISMATCH))
        new[:, 1:] += row[:, :-1]
        row += GAP
        np.maximum(new, row, out=new)
        np.maximum(new, 0, out=new)
        # A gap along the row: the best of what lies to the left, less its distance.
        new -= GAP * steps
        np.maximum.accumulate(new, axis=1, out=new)
        new += GAP * steps
        row = new
        k = row.argmax(axis=1)
        top = row[np.arange(n), k]
        end = np.where(top > best, k, np.where(top == best, np.minimum(end, k), end))
        best = np.maximum(best, top)
    return best, end


def padded(parts: list[np.ndarray], fill: int) -> np.ndarray:
    size = np.array([len(p) for p in parts])
    out = np.full((len(parts), size.max()), fill, np.int32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.concatenate(parts)
    return out


class Items:
    """A group of items; their words are numbered by `vocabulary`."""

    def __init__(self, ids: pa.Array, words: list[np.ndarray], threshold: float, min_words: int = MIN_WORDS):
        self.ids, self.size = ids, np.array([len(w) for w in words], np.int64)
        self.outer = np.concatenate([[0], np.cumsum(self.size)])
        self.vocabulary, flat = np.unique(np.concatenate(words), return_inverse=True)
        self.flat = flat.astype(np.int32)
        self.share = np.where(self.size < min_words, 1.0, threshold)
        # An alignment of `need` matches, or all words, can afford MATCH * (size - need) other words, each at a cost of at least 1.
        self.need = np.maximum(1, np.ceil(self.share * self.size - 1e-9)).astype(np.int64)
        self.reach = self.size + np.maximum(0, np.floor(MATCH * (1 - self.share) * self.size + 1e-9)).astype(np.int64)

    def seed(self, frequency: np.ndarray) -> None:
        """Chooses the seeds; `frequency` of the vocabulary decides the cost, not the result."""
        self.least = np.minimum(SEEDS, self.need)
        item = np.repeat(np.arange(len(self.size)), self.size)
        order = np.lexsort((self.flat, frequency[self.flat], item))
        rank = np.arange(len(order)) - self.outer[item]
        kept = order[rank < (self.size - self.need + self.least)[item]]
        pairs = np.unique(self.flat[kept].astype(np.int64) * len(self.size) + item[kept])
        self.posting = pairs % len(self.size)
        self.start = np.searchsorted(pairs // len(self.size), np.arange(len(self.vocabulary) + 1))

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """The words' places in the vocabulary, -1 for others."""
        k = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[k] == words, k, -1).astype(np.int32)

    def passages(self, w: np.ndarray, outer: np.ndarray):
        """Arrays (item, lo, hi) of the places that can hold an alignment that reaches the threshold, some hits at a time."""
        doc = np.repeat(np.arange(len(outer) - 1), np.diff(outer))
        hits = np.where(w >= 0, self.start[w + 1] - self.start[w], 0)
        part, most = (np.cumsum(hits) - hits) // HITS, int(self.reach.max())
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(w)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = a + np.flatnonzero(hits[a:b + most])
            n = hits[at]
            place = np.repeat(at, n)
            item = self.posting[np.arange(len(place)) - np.repeat(np.cumsum(n) - n - self.start[w[at]], n)]
            key = np.sort(item.astype(np.uint64) << np.uint64(40) | place.astype(np.uint64))
            item, place = (key >> np.uint64(40)).astype(np.int64), (key & np.uint64((1 << 40) - 1)).astype(np.int64)
            first = np.arange(len(key))
            last = first + self.least[item] - 1
            first = first[(last < len(key)) & (place < b)]
            last = last[first]
            i, p, q = item[first], place[first], place[last]
            fits = (item[last] == i) & (doc[p] == doc[q]) & (q - p < self.reach[i])
            i, p, q = i[fits], p[fits], q[fits]
            lo, hi = np.maximum(q - self.reach[i] + 1, outer[doc[p]]), np.minimum(p + self.reach[i], outer[doc[p] + 1])
            # Those that overlap become one.
            new = np.ones(len(i), bool)
            new[1:] = (i[1:] != i[:-1]) | (lo[1:] >= hi[:-1])
            if len(i):
                yield i[new], lo[new], hi[np.append(np.flatnonzero(new)[1:] - 1, len(i) - 1)]

    def words(self, item: int) -> np.ndarray:
        return self.flat[self.outer[item]:self.outer[item + 1]]

    def scores(self, w: np.ndarray, item: np.ndarray, lo: np.ndarray, hi: np.ndarray, known: dict) -> np.ndarray:
        """(score, end in the passage) of each; `known` holds those of passages met before."""
        keys = [(i, xxhash.xxh3_128_digest(w[a:b])) for i, a, b in zip(item.tolist(), lo.tolist(), hi.tolist())]
        todo = np.array(list({k: n for n, k in enumerate(keys) if k not in known}.values()), np.int64)
        todo = todo[np.lexsort((hi[todo] - lo[todo], self.size[item[todo]]))]
        length, a = hi[todo] - lo[todo], 0
        while a < len(todo):
            widest = np.maximum.accumulate(length[a:a + CELLS])
            b = a + max(1, int(np.searchsorted(widest * np.arange(1, len(widest) + 1), CELLS, "right")))
            some, a = todo[a:b], b
            items = padded([self.words(k) for k in item[some].tolist()], -3)
            parts = padded([w[x:y] for x, y in zip(lo[some].tolist(), hi[some].tolist())], -2)
            # Words of the item that the passage has at all bound the matches.
            met = np.zeros(len(some), np.int64)
            for x in items.T:
                met += (parts == x[:, None]).any(axis=1)
            for k in some[met < self.need[item[some]]].tolist():
                known[keys[k]] = (0, 0)
            can = np.flatnonzero(met >= self.need[item[some]])
            if len(can):
                for k, *found in zip(some[can].tolist(), *(x.tolist() for x in align(items[can], parts[can]))):
                    known[keys[k]] = tuple(found)
        out = np.array([known[k] for k in keys], np.int64).reshape(-1, 2)
        if len(known) > KNOWN:
            known.clear()
        return out


def _item_rows(batches):
    for batch in batches:
        words = [word_hashes([t.translate(WORD_BYTES)])[0] for t in byte_texts(batch.column(1))]
        out = pa.RecordBatch.from_arrays([batch.column(0), pa.array([w.tobytes() for w in words], pa.binary())], names=["item", "words"])
        yield out.filter(pa.array([len(w) > 0 for w in words], pa.bool_()))


def _counts(items):
    """(word, n) of the items' vocabulary, once a task."""
    def run(batches):
        n = np.zeros(len(items.value.vocabulary), np.int64)
        for batch in thin(batches):
            texts = byte_texts(batch.column(0))
            for i, j in slices(texts):
                w = items.value.numbers(word_hashes([t.translate(WORD_BYTES) for t in texts[i:j]])[0])
                n += np.bincount(w[w >= 0], minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"word": pa.array(some.astype(np.int32)), "n": pa.array(n[some])})

    return run


def _aligned(items):
    def run(batches):
        x, known = items.value, {}
        for batch in thin(batches):
            ids, marks = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            texts = byte_texts(batch.column(2))
            null = np.array(batch.column(0).is_null())
            for i, j in slices(texts):
                words, outer = word_hashes([t.translate(WORD_BYTES) for t in texts[i:j]])
                w, found = x.numbers(words), []
                for item, lo, hi in x.passages(w, outer):
                    score, end = x.scores(w, item, lo, hi, known).T
                    share, doc = score / (MATCH * x.size[item]), np.searchsorted(outer, lo, "right") - 1
                    k = np.flatnonzero(share >= x.share[item])
                    found += zip(doc[k].tolist(), item[k].tolist(), share[k].tolist(), (lo + end - outer[doc])[k].tolist())
                best = {}
                for doc, item, share, end in found:
                    best[doc, item] = max(best.get((doc, item), (0, 0)), (share, -end))
                if best:
                    d, k = np.array(list(best)).T
                    yield pa.RecordBatch.from_pydict({"id": pa.array(np.where(null[i + d], 0, ids[i + d]).astype(np.int64), mask=null[i + d]), "mark": pa.array(marks[i + d]), "item": x.ids.take(pa.array(k)),
                                                      "score": pa.array([s for s, _ in best.values()], pa.float64()), "end": pa.array([-e for _, e in best.values()], pa.int64())})

    return run


@in_small_batches
def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 min_words: int = MIN_WORDS, threshold: float = THRESHOLD, item_words: int = ITEM_WORDS) -> DataFrame:
    """(id, mark, item, score, end): document and item, the alignment's share of the item's own score, and the
    word of the document at which it ends. `mark` tells texts under one id apart."""
    spark = docs.sparkSession
    kind = benchmark.schema[item_id].dataType.simpleString()
    items = written(benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).mapInArrow(_item_rows, f"item {kind}, words binary"), "items")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(doc_id), F.col(text)).alias("mark"), F.col(text).alias("text"))
    found, groups = [], -(-(items.agg(F.sum(F.length("words"))).first()[0] or 0) // (8 * item_words))
    for k in range(groups):
        some = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(groups)) == k).toArrow().combine_chunks()
        if not some.num_rows:
            continue
        group = Items(pa.array(some["item"].to_pylist(), some["item"].type), [np.frombuffer(w, np.uint64) for w in some["words"].to_pylist()], threshold, min_words)
        # As many rows as the group's items have words, at most.
        counted = rows.select("text").mapInArrow(_counts(spark.sparkContext.broadcast(group)), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
        frequency = np.zeros(len(group.vocabulary), np.int64)
        frequency[counted["word"].to_numpy()] = counted["n"].to_numpy()
        group.seed(frequency)
        found.append(rows.mapInArrow(_aligned(spark.sparkContext.broadcast(group)), f"id long, mark long, item {kind}, score double, end long"))
    none = spark.createDataFrame([], f"id long, mark long, item {kind}, score double, end long")
    return written(reduce(DataFrame.unionByName, found).distinct(), "found") if found else none  # rows that repeat a document
