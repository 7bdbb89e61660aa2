"""What a worker holds at a time for its blocks of texts, by numpy's and Python's own count of bytes."""

import tracemalloc

import numpy as np
import pyarrow as pa

from creditspark.llm import decontam, passages, tables
from creditspark.llm import textcodes as tc

MB = 1 << 20


def peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def letters(n: int) -> bytes:
    return np.random.default_rng(7).integers(97, 123, n, np.uint8).tobytes()


def test_anchors_of_short_texts_are_found_in_small_blocks():
    raw = letters(4 * MB)
    data, offsets = tc.text_bytes(pa.array([raw[i : i + 2048].decode() for i in range(0, len(raw), 2048)]))
    found = []
    assert peak(lambda: found.append(passages.anchored(data, offsets))) < 64 * MB
    alone = [passages.anchored(data, offsets[i : i + 2]) for i in range(0, 40)]
    n = sum(len(a[0]) for a in alone)
    for part, pieces in zip(found[0][1:], zip(*(a[1:] for a in alone))):
        assert np.array_equal(part[:n], np.concatenate(pieces))


def test_stretches_of_few_grams_are_compared_at_a_time():
    raw, n = letters(3 * MB), 10_000
    cut = [raw[300 * (i // 2) : 300 * (i // 2) + 300] for i in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int64()), pa.array([i // 2 for i in range(n)], pa.int64()), pa.array(cut, pa.binary())],
        ["_row", "first", "gram", "bytes"],
    )
    parts = []
    assert peak(lambda: parts.extend(passages._compare([batch]))) < 96 * MB
    rows = [r for part in parts for r in part.to_pylist()]
    assert sorted(r["_row"] for r in rows) == list(range(n))
    assert {(r["start"], r["end"]) for r in rows} == {(0, 300)}


def test_powers_of_a_very_long_text_are_not_kept():
    up, down = tc.powers(5 * MB)
    assert len(up) == 5 * MB and up[-1] * down[-1] == 1
    assert sum(x.nbytes for pair in tc._powers.values() for x in pair) < 64 * MB


def test_words_of_a_batch_are_looked_for_in_small_blocks():
    raw = letters(4 * MB).replace(b"e", b" ")
    text = pa.array([raw[i : i + 2048].decode() for i in range(0, len(raw), 2048)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(text))), pa.array(range(len(text))), text], ["_row", "doc_id", "text"])
    parts = []
    find = decontam._find(np.zeros(1, np.uint64), [5])
    assert peak(lambda: parts.extend(find([batch]))) < 24 * MB
    assert parts[0].column("n_words").to_pylist() == [len(t.split()) for t in text.to_pylist()]


def test_a_task_gives_back_what_it_freed():
    def held() -> int:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def run(batches):
        # Small blocks stay with the process when freed, as the last one still in use lies behind them.
        blocks = [np.ones(12_000) for _ in range(2000)]
        kept.append(blocks[-1])
        before.append(held())
        del blocks
        yield from batches

    kept, before = [], []
    batch = pa.RecordBatch.from_pydict({"x": [1]})
    assert list(tables.returning(run)(iter([batch]))) == [batch]
    assert held() < before[0] - 100 * MB
