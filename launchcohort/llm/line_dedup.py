"""Lines that many documents share: two Bloom filters first, exact counts of the suspects after.

A first pass fills, per task, a filter of hashes seen once and one of hashes seen twice; filters of
different tasks merge to (once | once', twice | twice' | once & once'), segment by segment. Only
lines that the merged second filter holds are shuffled, as 16-byte keys with the smallest doc_id
that has them. Both filters have a fixed size (`filter_bits`): beyond about `filter_bits / 8`
different lines more lines travel, the result stays exact. Executors that are lost cost their tasks;
nothing is kept in memory between the passes.

Defined results: a null or empty text is one empty line; empty keys are never dropped; a line
repeated inside one document counts once for it; rows that repeat a doc_id count as documents of
their own; a text of which all lines go becomes empty. Input columns stay, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from launchcohort.llm.common import SPACE, BitFilter, byte_texts, shuffle_partitions, thin
from launchcohort.session import written

FILTER_BITS = 1 << 26
BROADCAST_KEYS = 1 << 20


def line_keys(text: bytes) -> list[bytes]:
    """A line's key: stripped of white space at both ends, A-Z lower-cased (bytes.lower does no more)."""
    return [line.strip(SPACE).lower() for line in text.split(b"\n")]


def _hashes(keys: set[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def _fill(bits: int):
    def run(batches):
        once, twice = BitFilter(bits), BitFilter(bits)
        for batch in thin(batches):
            seen = [_hashes(set(line_keys(t)) - {b""}) for t in byte_texts(batch.column(0))]
            h, n = np.unique(np.concatenate(seen) if seen else np.zeros(0, np.uint64), return_counts=True)
            twice.add(h[(n > 1) | once.holds(h)])
            once.add(h)
        a, b = once.segments(), twice.segments()
        yield pa.RecordBatch.from_pydict({"segment": pa.array(range(len(a)), pa.int32()), "once": pa.array(a, pa.binary()),
                                          "twice": pa.array(b, pa.binary())})

    return run


def _merge(bits: int):
    """Sorted rows of several segments; one pair of bitmaps at a time."""
    def run(batches):
        at, once, twice = None, None, None

        def done():
            return pa.RecordBatch.from_pydict({"segment": pa.array([at], pa.int32()), "twice": pa.array([b"b" + twice.tobytes()], pa.binary())})

        for batch in batches:
            for k, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = BitFilter.segment(a, bits), BitFilter.segment(b, bits)
                if k != at:
                    if at is not None:
                        yield done()
                    at, once, twice = k, a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        if at is not None:
            yield done()

    return run


def twice_seen(docs: DataFrame, text: str = "text", bits: int = FILTER_BITS) -> BitFilter:
    """The filter of keys that two documents may share. Only its fixed number of bits reaches the driver."""
    spark = docs.sparkSession
    parts = docs.select(F.col(text).alias("text")).mapInArrow(_fill(bits), "segment int, once binary, twice binary")
    merged = (parts.repartition(shuffle_partitions(spark), "segment").sortWithinPartitions("segment")
              .mapInArrow(_merge(bits), "segment int, twice binary"))
    return BitFilter.of_segments(bits, {r.segment: bytes(r.twice) for r in merged.toLocalIterator()})


def _suspects(shared):
    def run(batches):
        for batch in thin(batches):
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keys, doc, mark = [], [], []
            for i, m, t in zip(ids, marks, byte_texts(batch.column(2))):
                own = list(set(line_keys(t)) - {b""})
                if own:
                    hits = [own[k] for k in np.flatnonzero(shared.value.holds(np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))))]
                    keys += map(xxhash.xxh3_128_digest, hits)
                    doc += [i] * len(hits)
                    mark += [m] * len(hits)
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "doc": pa.array(doc, pa.int64()), "mark": pa.array(mark, pa.int64())})

    return run


def _drop(shared, gone, keep_first: bool):
    """Without the lines whose keys are in `gone` (a broadcast dict) or in the row's own list."""
    def run(batches):
        for batch in thin(batches):
            ids = batch.column("_doc").to_pylist()
            lists = batch.column("_gone").to_pylist() if gone is None else [None] * len(ids)
            n_lines, n_dropped, kept = [], [], []
            for i, t, own in zip(ids, byte_texts(batch.column("_text")), lists):
                lines, keys, stay = t.split(b"\n"), line_keys(t), []
                there = gone.value if gone is not None else {bytes(g["key"]): g["first"] for g in own or ()}
                maybe = shared.value.holds(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))).tolist() if there else [False] * len(keys)
                had: set[bytes] = set()
                for line, key, hit in zip(lines, keys, maybe):
                    if hit and key:
                        d = xxhash.xxh3_128_digest(key)
                        if d in there:
                            if not keep_first or i != there[d] or d in had:
                                continue
                            had.add(d)
                    stay.append(line)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["row", "n_lines", "n_dropped", "kept"])

    return run


def line_dedup(docs: DataFrame, min_docs: int = 10, doc_id: str = "doc_id", text: str = "text", keep: str = "none",
               filter_bits: int = FILTER_BITS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """`row` (a struct of all input columns but the text), n_lines, n_dropped and the text that is `kept`.

    Keys found in at least `min_docs` documents lose all their lines; with keep="first" the first
    such line of the smallest doc_id stays. At most `broadcast_keys` keys are broadcast; when there
    are more, each document's own keys reach it by joins.
    """
    if keep not in ("none", "first") or min_docs < 2:
        raise ValueError("keep is none or first, and min_docs at least 2")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(twice_seen(docs, text, filter_bits))
    mark = F.xxhash64(F.col(doc_id), F.col(text))
    suspects = (docs.select(F.col(doc_id).cast("long").alias("doc"), mark.alias("mark"), F.col(text).alias("text"))
                .mapInArrow(_suspects(shared), "key binary, doc long, mark long"))
    # Counted before the shuffle, so a line of a third of all documents sends one row per task.
    repeated = written(suspects.groupBy("key").agg(F.count("*").alias("n"), F.min("doc").alias("first")).where(F.col("n") >= min_docs).drop("n"), "repeated-lines")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns if c != text]).alias("_row"), F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("_text"), mark.alias("_mark"))
    gone = None
    if repeated.count() <= broadcast_keys:
        gone = spark.sparkContext.broadcast({bytes(r.key): r.first for r in repeated.toLocalIterator()})
        rows = rows.drop("_mark")
    else:
        own = (suspects.join(repeated, "key").groupBy("doc", "mark").agg(F.collect_set(F.struct("key", "first")).alias("_gone"))
               .withColumnsRenamed({"doc": "_d", "mark": "_m"}))
        rows = rows.join(own, F.col("_doc").eqNullSafe(F.col("_d")) & F.col("_mark").eqNullSafe(F.col("_m")), "left").select("_row", "_doc", "_text", "_gone")
    schema = StructType([StructField("row", rows.schema["_row"].dataType), StructField("n_lines", LongType()),
                         StructField("n_dropped", LongType()), StructField("kept", StringType())])
    return rows.mapInArrow(_drop(shared, gone, keep == "first"), schema)
