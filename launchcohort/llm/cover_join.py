"""Vectors of cosine at or above a threshold, by cover trees and dual traversal.

Equal vectors become one with a count first. Within a label, vectors are dealt to cells: a cell that
is too large for one task is split by pivots, a net of half its radius taken from a bounded sample
of it (all its vectors are then dealt, and the radii are of all). Cells and the nodes above them are
paired from the root down; a pair of nodes goes on only if the distance of their centres is at most
the sum of their covering radii and the threshold's distance. For each pair of cells left, one task
walks the two cells' cover trees, nested levels with halving radii, with the same bound; leaves are
decided by cosine in double precision. A task sends the number of links per vector and the links that
connect, not all pairs; components follow by stars.

What the bound can do depends on the data: where vectors of a label lie in all directions, no cell
is far from another, and the work per label stays quadratic in cells, though only distances of centres
are computed in most of them. Cells are bounded (`CELL`), so a label of any size spreads.

Defined results: vectors that are null, of length zero, or hold null or non-finite components, and
those with a null label or id, link with nothing; so do vectors of different lengths; rows that
repeat a vec_id with its vector are copies of it and link.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from launchcohort.llm.common import shuffle_partitions
from launchcohort.llm.components import components
from launchcohort.session import written

CELL = 2048
FAN = 16
SAMPLE = 512
SPLITS = 12
LEAF = 24
SLACK = 1e-7
POINT = ("path", "rep", "n", "key", "vec")


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _parse(batches):
    for batch in batches:
        key, vec, dim = [], [], []
        for v, label, i in zip(batch.column("vec").to_pylist(), batch.column("label").to_pylist(), batch.column("id").to_pylist()):
            x = None if not v or label is None or i is None or None in v else np.asarray(v, np.float64)
            if x is None or not np.isfinite(x).all() or not x.any():
                key.append(None), vec.append(None), dim.append(0)
            else:
                x = x + 0.0  # one zero
                key.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest()), vec.append(x.tobytes()), dim.append(len(x))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(dim, pa.int32()), pa.array(key, pa.binary()), pa.array(vec, pa.binary())],
                                         names=["id", "label", "dim", "key", "vec"])


def _net(x: np.ndarray, radius: float, most: int | None = None) -> np.ndarray:
    """Indices of centres, the first row among them, such that every row is within `radius` of one."""
    centres, far = [0], np.linalg.norm(x - x[0], axis=1)
    while len(centres) < (most or len(x)) and far.max() > radius:
        k = int(far.argmax())
        centres.append(k)
        np.minimum(far, np.linalg.norm(x - x[k], axis=1), out=far)
    return np.array(centres)


def _pivots(part: pa.Table) -> pa.Table:
    """Centres of a sampled cell, enough to bring it below the size of a cell or FAN of them."""
    part = part.sort_by("key")
    x = _unit(np.stack([np.frombuffer(v) for v in part.column("vec").to_pylist()]))
    radius = np.linalg.norm(x - x[0], axis=1).max()
    most = min(FAN, max(2, -(-2 * part.column("count")[0].as_py() // CELL)))
    picked = x[_net(x, radius / 2, most)]
    return pa.table({"node": part.column("node").slice(0, 1), "pivots": pa.array([picked.tobytes()], pa.binary())})


def _deal(round_: int):
    """The child of its node that each vector is nearest to. Vectors that no pivot tells apart, or that stay
    together after SPLITS rounds, are dealt by their hash: that costs pruning, not results."""
    def run(batches):
        for batch in batches:
            child = []
            for p, v, key in zip(*(batch.column(c).to_pylist() for c in ("pivots", "vec", "key"))):
                x = np.frombuffer(v)
                c = np.frombuffer(p).reshape(-1, len(x))
                best = int(np.linalg.norm(c - _unit(x[None]), axis=1).argmin()) if len(c) > 1 and round_ < SPLITS else key[round_ % 16] % FAN
                child.append(f"{best:02d}")
            yield pa.RecordBatch.from_arrays([batch.column("path").cast(pa.list_(pa.string())), *(batch.column(c) for c in POINT[1:]), pa.array(child, pa.string())], names=[*POINT, "child"])

    return run


class CoverTree:
    """Nested nets with halving radii over at most a cell of unit vectors.

    A node is (row of its centre, covering radius, its children or, in a leaf, its rows)."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.root = self._grow(np.arange(len(x)), 1.0)

    def _grow(self, rows: np.ndarray, radius: float):
        x = self.x[rows]
        reach = float(np.linalg.norm(x - x[0], axis=1).max())
        if len(rows) <= LEAF or reach <= 0:
            return rows[0], reach, None, rows
        while radius >= reach:
            radius /= 2
        centres = _net(x, radius)
        if len(centres) == len(rows):
            kids = [(rows[k], 0.0, None, rows[k:k + 1]) for k in centres]
        else:
            near = (x @ x[centres].T).argmax(axis=1)
            near[centres] = np.arange(len(centres))
            order = np.argsort(near, kind="stable")
            cuts = np.flatnonzero(np.diff(near[order])) + 1
            kids = []
            for part in np.split(order, cuts):
                c = centres[near[part[0]]]
                kids.append(self._grow(rows[np.concatenate([[c], part[part != c]])], radius / 2))
        return rows[0], reach, kids, rows


class Links:
    """Counts per row and links that connect, for two cells (or one with itself)."""

    def __init__(self, a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray, cosine: float, same: bool):
        self.ua, self.ub = _unit(a), _unit(b)
        self.a, self.b, self.wa, self.wb, self.cosine, self.same = a, b, wa, wb, cosine, same
        self.near = math.sqrt(max(0.0, 2 - 2 * cosine))
        self.na, self.nb = np.abs(a).max(axis=1), np.abs(b).max(axis=1)
        self.ca, self.cb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        # Which rows are connected already: a label per row, of both cells.
        self.second = 0 if same else len(a)
        self.part = np.arange(self.second + len(b))
        self.edges: list[tuple[int, int]] = []

    def exact(self, i: np.ndarray, j: np.ndarray) -> None:
        """Blocks of rows, by cosine."""
        p, q = self.a[i] / self.na[i][:, None], self.b[j] / self.nb[j][:, None]
        hit = (p @ q.T) / (np.linalg.norm(p, axis=1)[:, None] * np.linalg.norm(q, axis=1)[None]) >= self.cosine
        if self.same:
            hit &= i[:, None] != j[None]
        r, s = np.nonzero(hit)
        r, s = i[r], j[s]
        self.count(r, s)
        while len(open_ := np.flatnonzero(self.part[r] != self.part[self.second + s])):
            k = open_[0]
            self.part[self.part == self.part[self.second + s[k]]] = self.part[r[k]]
            self.edges.append((r[k], s[k]))

    def count(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.ca, i, self.wb[j])
        if not self.same:
            np.add.at(self.cb, j, self.wa[i])

    def walk(self, ta: CoverTree, tb: CoverTree) -> None:
        stack = [(ta.root, tb.root)]
        while stack:
            p, q = stack.pop()
            kp, kq = p[2] or [p], q[2] or [q]
            if (p[2] is None and q[2] is None) or len(p[3]) * len(q[3]) <= LEAF * LEAF * 4:
                self.exact(p[3], q[3])
                continue
            xp, xq = self.ua[[k[0] for k in kp]], self.ub[[k[0] for k in kq]]
            rp, rq = np.array([k[1] for k in kp]), np.array([k[1] for k in kq])
            for at in range(0, len(kp), 1024):
                d = np.sqrt(np.maximum(0, 2 - 2 * (xp[at:at + 1024] @ xq.T)))
                for i, j in zip(*np.nonzero(d <= rp[at:at + 1024, None] + rq[None] + self.near + SLACK)):
                    stack.append((kp[at + i], kq[j]))


def _pack(part: pa.Table) -> pa.Table:
    """A cell in one row."""
    part = part.sort_by("key")
    x = np.stack([np.frombuffer(v) for v in part.column("vec").to_pylist()])
    u = _unit(x)
    centre = u.mean(axis=0)
    return pa.table({"path": part.column("path").slice(0, 1).cast(pa.list_(pa.string())), "centre": pa.array([centre.tobytes()], pa.binary()),
                     "radius": pa.array([float(np.linalg.norm(u - centre, axis=1).max())], pa.float64()), "vecs": pa.array([x.tobytes()], pa.binary()),
                     "reps": pa.array([part.column("rep").to_pylist()], pa.list_(pa.int64())), "ns": pa.array([part.column("n").to_pylist()], pa.list_(pa.int64()))})


def _ball(part: pa.Table) -> pa.Table:
    """A node that covers its at most FAN children."""
    c = np.stack([np.frombuffer(v) for v in part.column("centre").to_pylist()])
    centre = c.mean(axis=0)
    reach = np.linalg.norm(c - centre, axis=1) + part.column("radius").to_numpy()
    return pa.table({"node": part.column("parent").slice(0, 1), "path": part.column("path").slice(0, 1).cast(pa.list_(pa.string())), "centre": pa.array([centre.tobytes()], pa.binary()),
                     "radius": pa.array([float(reach.max())], pa.float64())})


def _near_nodes(near: float):
    def run(batches):
        for batch in batches:
            ok = [np.linalg.norm(np.frombuffer(p) - np.frombuffer(q)) <= r + s + near + SLACK
                  for p, q, r, s in zip(*(batch.column(c).to_pylist() for c in ("ca", "cb", "ra", "rb")))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def near_cells(cells: DataFrame, depth: int, near: float) -> DataFrame:
    """(a, b) with a <= b: the pairs of cells that the bounds leave, found from the roots down."""
    def node(k: int):
        return F.array_join(F.slice("path", 1, k + 1), "/")

    levels = [cells.select(node(depth).alias("node"), "path", "centre", "radius")]
    for k in range(depth - 1, -1, -1):
        levels.insert(0, written(levels[0].withColumn("parent", node(k)).groupBy("parent").applyInArrow(_ball, "node string, path array<string>, centre binary, radius double"), "nodes"))
    pairs = levels[0].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for k in range(depth):
        side = {s: levels[k + 1].select(node(k).alias(f"p{s}"), F.col("node").alias(s), F.col("centre").alias(f"c{s}"), F.col("radius").alias(f"r{s}")) for s in "ab"}
        wide = (pairs.withColumnsRenamed({"a": "pa", "b": "pb"}).join(side["a"], "pa").join(side["b"], "pb").where("pa != pb or a <= b"))
        pairs = written(wide.select("a", "b", "ca", "cb", "ra", "rb").mapInArrow(_near_nodes(near), "a string, b string"), "node-pairs")
    return pairs


def _join_cells(cosine: float):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                reps = [np.array(row["reps_a"], np.int64), np.array(row["reps_b"], np.int64)]
                x, y = (np.frombuffer(row[f"vecs_{s}"]).reshape(len(r), -1) for s, r in zip("ab", reps))
                same = row["a"] == row["b"]
                got = Links(x, y, np.array(row["ns_a"]), np.array(row["ns_b"]), cosine, same)
                ta = CoverTree(got.ua)
                got.walk(ta, ta if same else CoverTree(got.ub))
                e = np.array(got.edges, np.int64).reshape(-1, 2).T
                e = np.stack([reps[0][e[0]], reps[1][e[1]]])
                id_, n = (reps[0], got.ca) if same else (np.concatenate(reps), np.concatenate([got.ca, got.cb]))
                some = n > 0
                k = int(some.sum())
                yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate([id_[some], e[0]])), "b": pa.array(np.concatenate([np.zeros(k, np.int64), e[1]])),
                                                  "n": pa.array(np.concatenate([n[some], np.zeros(e.shape[1], np.int64)]))})

    return run


def cover_join(vectors: DataFrame, cosine: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, n_links, component_id), one row per input row."""
    kind = vectors.schema[label].dataType.simpleString()
    rows = written(vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(embedding).alias("vec"))
                   .mapInArrow(_parse, f"id long, label {kind}, dim int, key binary, vec binary"), "vectors")
    group = F.concat_ws(":", F.col("label").cast("string"), F.col("dim").cast("string"))
    reps = written(rows.where("key is not null").groupBy("label", "dim", "key").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("vec").alias("vec")), "reps")
    schema = "path array<string>, rep long, n long, key binary, vec binary"
    points = reps.select(F.array(F.translate(group, "/", "_")).alias("path"), "rep", "n", "key", "vec")
    done, depth = None, 0
    while True:
        large = written(points.groupBy("path").count().where(F.col("count") > CELL), "large")
        small = points.join(large.select("path"), "path", "left_anti").select(*POINT)
        done = small if done is None else done.unionByName(small)
        if large.isEmpty():
            break
        big = points.join(large, "path")
        by_hash = Window.partitionBy("path").orderBy("key")
        sample = big.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= SAMPLE).select(F.array_join("path", "/").alias("node"), "key", "vec", "count")
        pivots = sample.groupBy("node").applyInArrow(_pivots, "node string, pivots binary")
        dealt = (big.withColumn("node", F.array_join("path", "/")).join(pivots, "node").select(*POINT, "pivots")
                 .mapInArrow(_deal(depth), schema + ", child string"))
        points = written(dealt.select(F.concat("path", F.array("child")).alias("path"), "rep", "n", "key", "vec"), "dealt")
        depth += 1
    cells = written(done.groupBy("path").applyInArrow(_pack, "path array<string>, centre binary, radius double, vecs binary, reps array<long>, ns array<long>"), "cells")
    pairs = near_cells(cells, depth, math.sqrt(max(0.0, 2 - 2 * cosine)))
    side = {s: cells.select(F.array_join("path", "/").alias(s), F.col("vecs").alias(f"vecs_{s}"), F.col("reps").alias(f"reps_{s}"), F.col("ns").alias(f"ns_{s}")) for s in "ab"}
    # Dealt anew by pair, as pairs are what takes time.
    work = pairs.join(side["a"], "a").join(side["b"], "b").repartition(2 * shuffle_partitions(vectors.sparkSession), "a", "b")
    found = written(work.mapInArrow(_join_cells(cosine), "a long, b long, n long"), "cell-links")
    links = found.where("n > 0").groupBy("a").agg(F.sum("n").alias("links")).withColumnRenamed("a", "rep")
    parts = components(found.where("n = 0").select("a", "b")).withColumnRenamed("node", "rep")
    named = (reps.select("label", "dim", "key", "rep", "n").join(links, "rep", "left").join(parts, "rep", "left")
             .select("label", "dim", "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    return (rows.select("id", "label", "dim", "key").join(named, ["label", "dim", "key"], "left")
            .select("id", "label", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")))
