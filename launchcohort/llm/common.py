"""What several operators share: bytes of texts, hashes of words, a bounded bit filter, tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

# The white space of every contract, [\x20\x09-\x0D]; bytes.split() splits on the same.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"

SLICE_BYTES = 4 << 20
# Rows of texts or sets that a task holds at once; Spark's default hands over ten thousand.
BATCH_ROWS = 1000
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_texts(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of about `limit` bytes, so that arrays stay small whatever a batch holds."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def thin(batches: Iterable[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most `rows` rows, so that what is made of a part, and sent back, stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def in_small_batches(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """While `operator`, called with a DataFrame first, runs its jobs, a batch has at most `BATCH_ROWS` rows; then the
    session's setting is as before. What it returns is not to need Python any more."""
    @wraps(operator)
    def run(docs: DataFrame, *args, **named) -> DataFrame:
        conf = docs.sparkSession.conf
        before = conf.get(BATCH_KEY)
        conf.set(BATCH_KEY, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
        try:
            return operator(docs, *args, **named)
        finally:
            conf.set(BATCH_KEY, before)

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(words: Iterable[bytes], count: int = -1) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, count)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in a row, and where each text's words start (one more entry at the end)."""
    words: list[bytes] = []
    ends = [0]
    for t in texts:
        words += t.split()
        ends.append(len(words))
    return hashes(words, len(words)), np.asarray(ends, np.int64)


class BitFilter:
    """A Bloom filter of a fixed number of bits. It is sent in segments, so merging is spread too.

    Its size is a parameter and does not grow with the input; when it fills up, more elements pass
    it and the exact step behind it has more to do.
    """

    SEGMENT_BITS = 1 << 19

    def __init__(self, bits: int):
        if bits & (bits - 1) or bits < 8:
            raise ValueError("bits must be a power of two of at least 8")
        self.bits, self.data = bits, np.zeros(bits >> 3, np.uint8)

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = np.uint64(self.bits - 1)
        return h & cut, (h >> np.uint64(32)) * np.uint64(0x9E3779B1) + h & cut

    def _get(self, p: np.ndarray) -> np.ndarray:
        return (self.data[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 != 0

    def holds(self, h: np.ndarray) -> np.ndarray:
        a, b = self.places(h)
        return self._get(a) & self._get(b)

    def add(self, h: np.ndarray) -> None:
        for p in self.places(h):
            np.bitwise_or.at(self.data, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))

    def segments(self) -> list[bytes]:
        """Each segment as a bitmap, or as its set places where these are fewer bytes."""
        step, out = max(1, min(self.bits, self.SEGMENT_BITS) >> 3), []
        for k in range(0, len(self.data), step):
            part = self.data[k:k + step]
            set_ = np.flatnonzero(part)
            if len(set_) * 5 < len(part):
                out.append(b"p" + set_.astype(np.uint32).tobytes() + part[set_].tobytes())
            else:
                out.append(b"b" + part.tobytes())
        return out

    @classmethod
    def segment(cls, packed: bytes, bits: int) -> np.ndarray:
        if packed[:1] == b"b":
            return np.frombuffer(packed, np.uint8, offset=1)
        out, n = np.zeros(max(1, min(bits, cls.SEGMENT_BITS) >> 3), np.uint8), (len(packed) - 1) // 5
        out[np.frombuffer(packed, np.uint32, n, 1)] = np.frombuffer(packed, np.uint8, n, 1 + 4 * n)
        return out

    @classmethod
    def of_segments(cls, bits: int, packed: dict[int, bytes]) -> BitFilter:
        self = cls(bits)
        step = max(1, min(bits, cls.SEGMENT_BITS) >> 3)
        for k, p in packed.items():
            self.data[k * step:(k + 1) * step] = cls.segment(p, bits)
        return self
