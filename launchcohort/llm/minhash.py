"""Near-duplicate documents by circulant MinHash, confirmed on full shingle sets.

Two permutations of a universe of 2**32 make a whole signature: the first renames a shingle, the
second is applied after a circular shift by k for coordinate k. Bands of `ROWS` coordinates are hashed
to buckets. With 48 bands of 5 rows a pair at similarity 0.8 misses all buckets with probability
5e-9.

Documents of equal sets form one class, and classes are what is compared. In a bucket every class
meets the smallest and the largest one; all pairs of up to three classes are covered by that. Where
larger buckets hold classes that are not yet connected, further rounds go on with another pivot per
bucket, and when the pairs left are no more than `PAIRS_PER_ROW` per row, the classes of such buckets
meet by their rarest shingles: of two sets this alike, the rarest fifth of the larger one and the rarest
ninth of the smaller one, in one order of all shingles, have a shingle in common. So groups of
thousands of near copies cost some comparisons per document, copies that are alike but not linked meet
only where they also share what is rare among them, and no pair that could connect is left out. A pair
goes on only if its set sizes allow the similarity, counting as common at most the
shingles of either that any other candidate has (so copies that each have many words of their own are
not compared with each other), and the lowest bits of its signatures differ in at most `DIFFERENT` of 240 coordinates; at similarity 0.8 those bits differ in 24
on average, and in more than 56 with a probability below 1e-9. Signatures only find candidates; the
links come from intersections of the full sets.

A bucket's pivots are found by sums made before the shuffle, joins on buckets, pivots and classes
are plain ones that Spark may split where they are skewed, and the candidates' sets are the only ones
written. Rounds read tables in the shared folder.

Defined results: shingles are those of words [^\\x20\\x09-\\x0D]+ of the text with A-Z lower-cased;
with fewer words than a shingle the whole sequence is one; no words (or null): an empty set, linked
with nothing; rows that repeat doc_id and text are one document; a component is named by its smallest
doc_id that is not null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from launchcohort.llm.common import byte_texts, in_small_batches, mix, shuffle_partitions, slices, thin, word_hashes
from launchcohort.llm.components import stars
from launchcohort.session import written

BANDS, ROWS = 48, 5
SIMILARITY = 80
BROADCAST_DOCS = 1 << 20
BROADCAST_NODES = 1 << 16
BROADCAST_PAIRS = 1 << 16
PIVOT_ROUNDS = 3
PAIRS_PER_ROW = 64
DIFFERENT = 56


def shingle_sets(texts: list[bytes], words_per: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, outer = word_hashes([t.lower() for t in texts])
    h = np.zeros(len(words), np.uint64)
    for k in range(words_per):  # the last words of a text reach into the next; those are not used
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + mix(np.roll(words, -k) + np.uint64(k)))
    out = []
    for a, b in zip(outer[:-1].tolist(), outer[1:].tolist()):
        if b - a >= words_per:
            out.append(np.unique(h[a:b - words_per + 1]))
        elif b > a:
            out.append(mix(np.array([hash_of_short(words[a:b])], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def hash_of_short(words: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(words.tobytes(), digest_size=8, person=b"short").digest(), "little")


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of minima per set; the sets are not empty."""
    flat = (mix(np.concatenate(sets)) >> np.uint64(32)).astype(np.uint32)  # the first permutation, cut to the universe
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((coordinates, len(sets)), np.uint32)
    x, t = np.empty_like(flat), np.empty_like(flat)
    for k in range(coordinates):
        # The second permutation, at places shifted by k round the universe.
        np.add(flat, np.uint32(k), out=x)
        for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
            np.right_shift(x, np.uint32(shift), out=t)
            np.bitwise_xor(x, t, out=x)
            np.multiply(x, np.uint32(factor), out=x)
        out[k] = np.minimum.reduceat(x, starts)
    return out.T


def buckets(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit bucket per set and band."""
    s = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    h = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64)), (len(s), bands))
    for k in range(rows):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + s[:, :, k])
    return h


def lowest_bits(signature: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, 64 to a number."""
    bits = np.packbits((signature & 1).astype(np.uint8), axis=1)
    return np.ascontiguousarray(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8)))).view(np.int64)


def class_of(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=12).digest()


def _sign(words_per: int, bands: int, rows: int):
    def run(batches):
        for batch in thin(batches):
            texts = byte_texts(batch.column(2))
            for i, j in slices(texts, 2 << 20):
                sets = shingle_sets(texts[i:j], words_per)
                full = [k for k, s in enumerate(sets) if len(s)]
                found: list = [None] * len(sets)
                sketch: list = [None] * len(sets)
                if full:
                    signed = signatures([sets[k] for k in full], bands * rows)
                    got = buckets(signed, bands, rows).view(np.int64)
                    for k, b, low in zip(full, got, lowest_bits(signed)):
                        found[k], sketch[k] = b, low
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(map(len, sets), pa.int64()),
                     pa.array([class_of(s) if len(s) else None for s in sets], pa.binary()), pa.array(found, pa.list_(pa.int64())),
                     pa.array(sketch, pa.list_(pa.int64()))],
                    names=["id", "mark", "n_shingles", "node", "buckets", "sketch"])

    return run


def _sets(words_per: int):
    def run(batches):
        for batch in thin(batches):
            texts = byte_texts(batch.column(0))
            for i, j in slices(texts):
                sets = shingle_sets(texts[i:j], words_per)
                yield pa.RecordBatch.from_arrays([pa.array(map(class_of, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"])

    return run


SHINGLE = np.dtype([("shingle", "<u8"), ("node", "<u4")])
MANY = 0xFFFFFFFF


def _spread_shingles(groups: int):
    """Packed (shingle, place of its node) by hash; one that repeats in a slice is sent once, as met by many."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [np.frombuffer(s, np.uint64) for s in part.column("shingles").to_pylist()]
                rows = np.zeros(sum(map(len, sets)), SHINGLE)
                rows["shingle"] = np.concatenate(sets)
                rows["node"] = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                rows.sort(order="shingle")
                first = np.flatnonzero(np.append(True, rows["shingle"][1:] != rows["shingle"][:-1])[:len(rows)])
                n = np.diff(np.append(first, len(rows)))
                rows = rows[first]
                rows["node"][n > 1] = MANY
                group = (rows["shingle"] % np.uint64(groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                cuts = np.searchsorted(group[order], np.arange(groups + 1))
                full = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), pa.array([part.column("node").to_pylist()] * len(full), pa.list_(pa.binary())),
                     pa.array([rows[order[cuts[g]:cuts[g + 1]]].tobytes() for g in full], pa.binary())], names=["group", "nodes", "blob"])

    return run


def _single(part: pa.Table) -> pa.Table:
    """How many shingles of each node no other one has."""
    nodes, blobs = part.column("nodes").to_pylist(), [np.frombuffer(b, SHINGLE) for b in part.column("blob").to_pylist()]
    rows = np.concatenate(blobs)
    home = np.repeat(np.arange(len(blobs)), [len(b) for b in blobs])
    order = np.argsort(rows["shingle"], kind="stable")
    s = rows["shingle"][order]
    edge = np.concatenate([[True], s[1:] != s[:-1], [True]])
    alone = order[edge[:-1] & edge[1:]]
    alone = alone[rows["node"][alone] != MANY]
    where, n = np.unique(np.stack([home[alone], rows["node"][alone].astype(np.int64)]), axis=1, return_counts=True)
    return pa.table({"node": pa.array([nodes[h][k] for h, k in where.T.tolist()], pa.binary()), "n": pa.array(n, pa.int64())})


def _compare(similarity: int):
    def run(batches):
        for batch in thin(batches):
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                n, m = len(x) // 8, len(y) // 8
                if 100 * min(n, m) < similarity * max(n, m):
                    keep.append(False)
                    continue
                both = np.sort(np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= similarity * (n + m - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _shingles(batches):
    """(node, shingles) with the packed shingles as a list."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sets = [np.frombuffer(s, np.int64) for s in part.column("shingles").to_pylist()]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))], names=["node", "shingles"])


def rare_meetings(sets: DataFrame, similarity: int, about: DataFrame | None = None, also: str = "true") -> DataFrame:
    """(a, b): nodes whose sets (node, shingles) may be similar, for they share a shingle among their rarest.

    `about` has further columns of each node; `also` is a condition on those of both, x and y, that the join applies.

    All shingles stand in one order, by the sets that hold them and then by value. With
    100 * common >= similarity * union, of two sets the larger one has at least similarity / 100 of its
    own shingles in common, the smaller one 2 * similarity / (100 + similarity); so the first common
    shingle lies before what may be missing of each, and behind it there is room for the others.
    A pair may come more than once; shingles of one set alone take their place but are not sent.
    """
    each = sets.mapInArrow(_shingles, "node binary, shingles array<long>").select("node", F.explode("shingles").alias("shingle"))
    held = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    lists = (each.join(held, "shingle", "left").groupBy("node")
             .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "shingle"))).alias("order")).withColumn("size", F.size("order")))
    least = {"probe": f"(size * {similarity} + 99) div 100", "index": f"(size * {2 * similarity} + {99 + similarity}) div {100 + similarity}"}
    reach = lists.select("node", "size", F.posexplode(F.slice("order", F.lit(1), F.expr(f"int(size - {least['probe']} + 1)"))).alias("at", "s"),
                         F.expr(f"size - {least['index']}").alias("last")).where("s.n > 1")
    rare = reach.select("node", "size", "at", "last", "s.shingle")
    rare = written(rare if about is None else rare.join(about, "node"), "rare")
    x, y = rare.alias("x"), rare.where("at <= last").alias("y")
    room = "least(x.size - x.at, y.size - y.at)"
    fits = f"(100 + {similarity}) * ({room}) >= {similarity} * (x.size + y.size)"
    larger = "(x.size > y.size or x.size = y.size and x.node > y.node)"
    return x.join(y, F.expr(f"x.shingle = y.shingle and {larger} and {fits} and {also}")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def only(docs: DataFrame, keys: DataFrame, how: str = "left_semi", doc_id: str = "doc_id", text: str = "text", limit: int = BROADCAST_DOCS) -> DataFrame:
    """The documents whose (id, mark) is among `keys` (or, with left_anti, is not). Up to `limit` keys are
    broadcast, after they have been counted; more are joined by a shuffle."""
    keys = keys.select(F.col("id").alias("_key_id"), F.col("mark").alias("_key_mark"))
    small = F.broadcast(keys) if keys.count() <= limit else keys
    return docs.join(small, docs[doc_id].eqNullSafe(F.col("_key_id")) & F.xxhash64(docs[doc_id], docs[text]).eqNullSafe(F.col("_key_mark")), how)


@in_small_batches
def near_duplicates(docs: DataFrame, words_per: int = 5, similarity: int = SIMILARITY, doc_id: str = "doc_id", text: str = "text",
                    bands: int = BANDS, rows: int = ROWS, pivot_rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """(id, mark, n_shingles, component_id), one row per document; `mark` tells texts under one id apart.

    Documents are linked when 100 * intersection >= similarity * union of their shingle sets.
    """
    groups = shuffle_partitions(docs.sparkSession)
    mark = F.xxhash64(F.col(doc_id), F.col(text)).alias("mark")
    signed = written(docs.select(F.col(doc_id).cast("long").alias("id"), mark, F.col(text).alias("text"))
                     .mapInArrow(_sign(words_per, bands, rows), "id long, mark long, n_shingles long, node binary, buckets array<long>, sketch array<long>"), "signed")
    classes = written(signed.where("node is not null").groupBy("node").agg(F.min("id").alias("least"), F.min_by("mark", F.struct("id", "mark")).alias("mark"), F.min_by("id", F.struct("id", "mark")).alias("id"),
                                                                           F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("size")), "classes")
    each = classes.select("node", "size", F.explode("buckets").alias("bucket"))
    shared = each.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1")
    met = written(each.join(shared, "bucket"), "met")
    words = -(-bands * rows // 64)
    limit = DIFFERENT * bands * rows // (BANDS * ROWS)

    def alike(a: str, b: str) -> str:
        """Whether two columns (size, common, sketch) may be similar."""
        differ = " + ".join(f"bit_count({a}.sketch[{k}] ^ {b}.sketch[{k}])" for k in range(words))
        common = f"least({a}.common, {b}.common)"
        return f"100 * {common} >= {similarity} * ({a}.size + {b}.size - {common}) and {differ} <= {limit}"

    nodes = written(classes.drop("buckets", "least").join(met.select("node").distinct(), "node", "left_semi"), "nodes")
    texts = only(docs.select(doc_id, text), nodes, doc_id=doc_id, text=text).select(text)
    sets = written(texts.mapInArrow(_sets(words_per), "node binary, shingles binary").dropDuplicates(["node"]), "sets")

    single = (sets.mapInArrow(_spread_shingles(groups), "group int, nodes array<binary>, blob binary").groupBy("group").applyInArrow(_single, "node binary, n long")
              .groupBy("node").agg(F.sum("n").alias("n")))
    small = nodes.count() <= BROADCAST_NODES

    def near(of_nodes: DataFrame) -> DataFrame:
        """A table of at most one row a node, each of some 100 bytes, is broadcast where there are few nodes."""
        return F.broadcast(of_nodes) if small else of_nodes

    facts = written(nodes.join(near(single), "node", "left").select("node", F.struct("size", (F.col("size") - F.coalesce("n", F.lit(0))).alias("common"), "sketch").alias("facts")), "facts")

    def links(pairs: DataFrame, name: str) -> DataFrame:
        """Pairs (a, b) are made distinct, then their facts are looked at, then their sets. Where few pairs are left,
        they are broadcast, so that no sets travel but theirs."""
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        for x, side in (("x", "a"), ("y", "b")):
            pairs = pairs.join(near(facts.select(F.col("node").alias(side), F.col("facts").alias(x))), side)
        pairs = written(pairs.where(alike("x", "y")).select("a", "b"), "alike")
        if pairs.count() <= BROADCAST_PAIRS:
            ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node"))
            met_sets = sets.join(F.broadcast(ends), "node").groupBy("a", "b").agg(
                *[F.first(F.when(F.col("node") == F.col(x), F.col("shingles")), ignorenulls=True).alias(f"s{x}") for x in "ab"])
        else:
            side = {x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab"}
            met_sets = pairs.join(side["a"], "a").join(side["b"], "b")
        return written(met_sets.mapInArrow(_compare(similarity), "a binary, b binary"), name)

    of_size = F.struct("node", "size")
    ends = met.groupBy("bucket").agg(F.min(of_size).alias("lo"), F.max(of_size).alias("hi"))
    first = met.select("bucket", of_size.alias("x")).join(ends, "bucket").select("x", F.explode(F.array("lo", "hi")).alias("y"))
    first = first.where(f"x.node != y.node and 100 * least(x.size, y.size) >= {similarity} * greatest(x.size, y.size)")
    found = links(first.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), "near")
    tied = stars(found).toDF("node", "component")  # a component's smallest node has no row
    open_ = met.where("m > 3")
    for k in range(pivot_rounds + 1):  # classes only grow together, so a bucket that is not open stays so
        wide = written(open_.select("bucket", "node").join(near(tied), "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("part")), "wide")
        split = wide.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo != hi").select("bucket")
        open_ = written(wide.join(split, "bucket"), "open")
        n = open_.groupBy("bucket", "part").agg(F.count("*").cast("double").alias("n")).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"))
        rows_, pairs_ = n.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum(F.col("n") * F.col("n") - F.col("nn")) / 2, F.lit(0.0))).first()
        if not rows_:
            break
        last = pairs_ <= PAIRS_PER_ROW * rows_ or k == pivot_rounds
        if last:
            about = open_.select("node", "part").distinct().join(near(facts), "node")
            pairs = rare_meetings(sets.join(about, "node", "left_semi"), similarity, about, f"x.part != y.part and {alike('x.facts', 'y.facts')}")
        else:
            pivots = open_.groupBy("bucket").agg(F.min_by(F.struct(F.col("node").alias("b"), F.col("part").alias("other")), F.xxhash64("node", F.lit(k))).alias("p")).select("bucket", "p.*")
            pairs = open_.join(pivots, "bucket").where("part != other").select(F.col("node").alias("a"), "b")
        more = links(pairs, "near")
        if not more.isEmpty():
            tied = stars(more.unionByName(tied.toDF("a", "b"))).toDF("node", "component")
        if last:
            break
    least = classes.select("node", "least").join(tied, "node", "left").select("node", "least", F.coalesce("component", "node").alias("part"))
    named = least.groupBy("part").agg(F.min("least").alias("component_id"))
    of_class = least.join(named, "part").select("node", "component_id")
    return signed.select("id", "mark", "n_shingles", "node").join(of_class, "node", "left").select("id", "mark", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
