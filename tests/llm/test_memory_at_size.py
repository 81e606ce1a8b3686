"""What a task of the corpus pipeline's steps holds at once."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from launchcohort.llm import common, decontamination, line_dedup, minhash


def texts(n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"id": pa.array(range(n), pa.int64()), "mark": pa.array(range(n), pa.int64()), "text": pa.array([f"some words of text {k}\nof two lines" for k in range(n)])})


def test_large_batches_are_taken_in_parts():
    """Also the rows that are sent back; none is lost."""
    batch = texts(2500)
    signed = list(minhash._sign(2, minhash.BANDS, minhash.ROWS)([batch, batch.slice(0, 0)]))
    sets = list(minhash._sets(2)([batch.select(["text"])]))
    for made in (signed, sets):
        assert [b.num_rows for b in made] == [1000, 1000, 500]
    assert pa.Table.from_batches(signed)["id"].to_pylist() == list(range(2500))

    class Shared:
        value = common.BitFilter(1 << 10)

    class Gone:
        value: dict = {}

    rows = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("id"), batch.column("text")], names=["_row", "_doc", "_text"])
    dropped = list(line_dedup._drop(Shared, Gone, False)([rows]))
    assert [b.num_rows for b in dropped] == [1000, 1000, 500]
    assert pa.Table.from_batches(dropped)["kept"].to_pylist() == batch.column("text").to_pylist()


def test_hits_of_seeds_are_held_some_at_a_time():
    """A slice of 600,000 words, every fourth a seed of 16 items."""
    words = np.arange(1, 41, dtype=np.uint64)
    items = decontamination.Items(pa.array(range(16)), [words] * 16, 0.5)
    items.seed(np.ones(40, np.int64))
    w = np.full(600_000, -1, np.int32)
    w[::4] = items.posting.size and np.flatnonzero(np.diff(items.start))[0]
    tracemalloc.start()
    for _ in items.passages(w, np.array([0, len(w)])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20


def test_small_batches_hold_while_an_operator_runs(spark):
    conf, met = spark.conf, []
    run = common.in_small_batches(lambda docs, fails: met.append(conf.get(common.BATCH_KEY)) or 1 // fails)
    before = conf.get(common.BATCH_KEY)
    for own, held in (("0", "1000"), ("10", "10"), ("20000", "1000")):
        conf.set(common.BATCH_KEY, own)
        for fails in (1, 0):
            try:
                run(spark.range(1), fails)
            except ZeroDivisionError:
                pass
            assert met.pop() == held and conf.get(common.BATCH_KEY) == own
    conf.set(common.BATCH_KEY, before)
