"""Hard negatives: for an anchor and each of its positives, rows of other labels that score a set share of it.

Scores are integer inner products. Tiles of anchors and candidates are multiplied by Strassen's recursion
over int64 (seven products of halves instead of eight, odd sides padded with a zero), so every sum is
exact. A task keeps two kinds of bounded heaps while its tiles pass: an anchor's best positives, and,
once those are known, the best rows within each positive's window. Heaps of tasks merge in any order,
first in lanes, then all, so no group holds more than a bounded heap per lane.

Anchors are a stated query set held against all rows. They are dealt by hash into chunks of at most
`ANCHORS_AT_ONCE`; one chunk is broadcast at a time (8 MB at 64 dimensions) and all rows stream past
it, once for positives and once for windows. Rows are neither shuffled for it nor sent more than once.

Defined results: rows with a null id, label or vector, or a null, NaN or infinite component, take no
part; rows equal in id, label and vector are one row, other rows of one id are rows of their own; ties
of score go by id, then by the hash of the vector; shorter vectors count as ending in zeros; components
are cut to 64 bits and scores taken modulo 2**64, so a score is exact if it fits a long; with a
positive score below zero no score lies in the window. No anchors, positives or negatives: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from launchcohort.session import written

ANCHORS_AT_ONCE = 16_384
PART, TILE, LEAF, LANES = 128, 2048, 16, 32
HEAPS = "part int, lane int, score binary, id binary, mark binary, full binary"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b over int64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return np.einsum("ik,kj->ij", a, b)
    a, b = np.pad(a, ((0, m & 1), (0, k & 1))), np.pad(b, ((0, k & 1), (0, n & 1)))
    (i, j), c = (s // 2 for s in a.shape), b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :c], b[:j, c:], b[j:, :c], b[j:, c:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    q = strassen(a21 + a22, b11, leaf)
    r = strassen(a11, b12 - b22, leaf)
    s = strassen(a22, b21 - b11, leaf)
    t = strassen(a11 + a12, b22, leaf)
    u = strassen(a21 - a11, b11 + b12, leaf)
    v = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * c), np.int64)
    out[:i, :c], out[:i, c:] = p + s - t + v, r + t
    out[i:, :c], out[i:, c:] = q + s, p - q + r + u
    return out[:m, :n]


class Heaps:
    """The best `size` of each of `count` anchors: score, id and mark, and whether a place is filled."""

    def __init__(self, count: int, size: int):
        self.score, self.id, self.mark = (np.zeros((count, size), np.int64) for _ in range(3))
        self.full = np.zeros((count, size), bool)

    def add(self, rows, score, id, mark, full) -> None:
        """Merges further entries, one line each for the anchors `rows`."""
        size = self.score.shape[1]
        score, id, mark, full = (np.concatenate([own[rows], more], axis=1) for own, more in
                                 ((self.score, score), (self.id, id), (self.mark, mark), (self.full, full)))
        order = np.lexsort((mark, id, ~score, ~full), axis=1)[:, :size]
        for own, all_ in ((self.score, score), (self.id, id), (self.mark, mark), (self.full, full)):
            own[rows] = np.take_along_axis(all_, order, axis=1)

    def add_tile(self, rows, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> None:
        """The best of a tile, one line per anchor; its columns are in the order of id and mark."""
        size = min(self.score.shape[1], scores.shape[1])
        left, fits, line = np.where(fits, scores, np.iinfo(np.int64).min), fits.copy(), np.arange(len(scores))
        at, full = np.zeros((len(scores), size), np.int64), np.zeros((len(scores), size), bool)
        for k in range(size):
            best = left.argmax(axis=1)  # the first of the highest: the smallest id
            got = fits[line, best]
            # The lowest long marks what is taken or does not fit; a score of just that value is looked for there.
            for i in np.flatnonzero(~got & (left[line, best] == np.iinfo(np.int64).min)):
                if fits[i].any():
                    best[i], got[i] = fits[i].argmax(), True
            at[:, k], full[:, k] = best, got
            left[line, best], fits[line, best] = np.iinfo(np.int64).min, False
        self.add(rows, np.take_along_axis(scores, at, axis=1), ids[at], marks[at], full)

    def packed(self, lane: int) -> pa.RecordBatch:
        """One row per part of the anchors."""
        cuts = range(0, len(self.score), PART)
        names = ("score", "id", "mark", "full")
        return pa.RecordBatch.from_arrays(
            [pa.array([c // PART for c in cuts], pa.int32()), pa.array([lane] * len(cuts), pa.int32()),
             *[pa.array([getattr(self, x)[c:c + PART].tobytes() for c in cuts], pa.binary()) for x in names]], names=["part", "lane", *names])

    @classmethod
    def merged(cls, table: pa.Table, size: int) -> Heaps:
        """The heaps of one part, from the rows of several tasks."""
        out = None
        for row in table.to_pylist():
            arrays = [np.frombuffer(row[x], np.int64).reshape(-1, size) for x in ("score", "id", "mark")] + [np.frombuffer(row["full"], bool).reshape(-1, size)]
            out = out or cls(len(arrays[0]), size)
            out.add(np.arange(len(arrays[0])), *arrays)
        return out


def merge(heaps: DataFrame, size: int) -> DataFrame:
    """One row per part; tasks are merged in lanes first."""
    def one(part: pa.Table) -> pa.Table:
        lane, no = part.column("lane")[0].as_py(), part.column("part")[0].as_py()
        out = pa.Table.from_batches([Heaps.merged(part, size).packed(lane)])
        return out.set_column(0, "part", pa.array([no], pa.int32()))

    return heaps.groupBy("part", "lane").applyInArrow(one, HEAPS).withColumn("lane", F.lit(0)).groupBy("part").applyInArrow(one, HEAPS)


class Anchors:
    """A chunk of anchors as arrays, in the order of id and mark."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: (r["id"], r["mark"]))
        self.id, self.label, self.mark = (np.array([r[x] for r in rows], np.int64) for x in ("id", "label", "mark"))
        self.vec = matrix([r["vec"] for r in rows])


def matrix(vectors: list) -> np.ndarray:
    """Vectors as lines of int64, padded with zeros to the longest."""
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)), np.int64)
    for line, v in zip(out, vectors):
        line[:len(v)] = v
    return out


def tiles(batches, anchors: Anchors):
    """(anchors' places, scores, candidates' ids, labels and marks) of every tile; candidates in the order of id and mark."""
    for batch in batches:
        for at in range(0, batch.num_rows, TILE):
            part = batch.slice(at, TILE)
            ids, labels, marks = (part.column(x).to_numpy(zero_copy_only=False) for x in ("id", "label", "mark"))
            order = np.lexsort((marks, ids))
            vec = part.column("vec")
            length = np.diff(vec.offsets.to_numpy())
            flat = vec.flatten().to_numpy(zero_copy_only=False)
            if len(length) and (length == length[0]).all():
                b = flat.reshape(len(length), -1)[order]
            else:
                b = matrix([x for x in vec.to_pylist()])[order]
            a, width = anchors.vec, max(anchors.vec.shape[1], b.shape[1])
            b = np.ascontiguousarray(np.pad(b, ((0, 0), (0, width - b.shape[1]))).T)
            for i in range(0, len(a), PART):
                rows = np.arange(i, min(i + PART, len(a)))
                yield rows, strassen(np.pad(a[rows], ((0, 0), (0, width - a.shape[1]))), b), ids[order], labels[order], marks[order]


def _lane() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId() % LANES


def hard_negatives(rows: DataFrame, anchors: Column, id: str = "id", label: str = "label", vector: str = "vector", scale: float = 256.0,
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, anchors_at_once: int = ANCHORS_AT_ONCE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x). `anchors` is a condition on the rows. An anchor's positives are its
    best `positives` other rows of the same label; each gets the best `negatives` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    spark = rows.sparkSession
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vec = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    part = rows.where(F.col(id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & whole)
    part = part.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), vec.alias("vec"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    all_ = written(part.groupBy("id", "label", "vec").agg(F.max("anchor").alias("anchor")).withColumn("mark", F.xxhash64("vec")), "vectors")
    asked = all_.where("anchor")
    chunks = max(1, -(-asked.count() // anchors_at_once))
    out = None
    # The hash deals anchors evenly; a chunk holds `anchors_at_once` of them but for chance.
    for chunk in range(chunks):
        mine = Anchors(asked.where(F.pmod(F.xxhash64("id", "mark", F.lit(11)), F.lit(chunks)) == chunk).select("id", "label", "vec", "mark").collect())
        if not len(mine.id):
            continue
        shared = spark.sparkContext.broadcast(mine)

        def same_label(batches):
            a = shared.value
            heaps, lane = Heaps(len(a.id), positives), _lane()
            for at, scores, ids, labels, marks in tiles(batches, a):
                other = (ids != a.id[at, None]) | (marks != a.mark[at, None])
                heaps.add_tile(at, scores, (labels == a.label[at, None]) & other, ids, marks)
            yield heaps.packed(lane)

        best = written(merge(all_.select("id", "label", "mark", "vec").mapInArrow(same_label, HEAPS), positives), "positives")
        found = sorted(best.collect(), key=lambda r: r["part"])  # a chunk's heaps, as bounded as its anchors
        near = [np.concatenate([np.frombuffer(r[x], kind).reshape(-1, positives) for r in found]) for x, kind in (("score", np.int64), ("id", np.int64), ("full", bool))]
        windows = spark.sparkContext.broadcast(near)

        def in_window(batches):
            a, (score, _, full) = shared.value, windows.value
            # 100 * x >= low * s and 100 * x <= high * s without products that leave 64 bits.
            least = score // 100 * low - (-(score % 100 * low) // 100)
            most = score // 100 * high + score % 100 * high // 100
            heaps, lane = [Heaps(len(a.id), negatives) for _ in range(positives)], _lane()
            for at, scores, ids, labels, marks in tiles(batches, a):
                other = labels != a.label[at, None]
                for k in range(positives):
                    fits = other & full[at, k, None] & (scores >= least[at, k, None]) & (scores <= most[at, k, None])
                    hit = np.flatnonzero(fits.any(axis=1))
                    if len(hit):
                        heaps[k].add_tile(at[hit], scores[hit], fits[hit], ids, marks)
            whole = Heaps(len(a.id), positives * negatives)
            for x in ("score", "id", "mark", "full"):
                setattr(whole, x, np.concatenate([getattr(h, x) for h in heaps], axis=1))
            # One line per anchor and positive, so that lines merge as heaps of `negatives`.
            for x in ("score", "id", "mark", "full"):
                setattr(whole, x, getattr(whole, x).reshape(-1, negatives))
            yield whole.packed(lane)

        def as_rows(batches):
            a, (score, id_, _) = shared.value, windows.value
            for batch in batches:
                for row in batch.to_pylist():
                    line = row["part"] * PART + np.arange(len(row["full"]) // negatives)
                    got = [np.frombuffer(row[x], kind).reshape(-1, negatives) for x, kind in (("score", np.int64), ("id", np.int64), ("full", bool))]
                    at, k = np.nonzero(got[2])
                    anchor, slot = line[at] // positives, line[at] % positives
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a.id[anchor]), pa.array(id_[anchor, slot]), pa.array(k + 1, pa.int32()), pa.array(got[1][at, k]), pa.array(score[anchor, slot]), pa.array(got[0][at, k])],
                        names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        found = merge(all_.select("id", "label", "mark", "vec").mapInArrow(in_window, HEAPS), negatives).mapInArrow(as_rows, schema)
        if chunks > 1:  # the chunk's broadcasts go before the next one's come
            found = written(found, "hard-negatives")
            shared.destroy()
            windows.destroy()
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
