"""64-bit codes of words and shingles for whole Arrow batches of texts.

A batch is looked at as one array of UTF-8 bytes, so a word costs a few vector
operations and no Python object. Codes are polynomial sums modulo 2**64 with a
final mix; long texts are worked through in blocks cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# A worker holds about six numbers of 8 bytes for each byte of a block.
BLOCK_BYTES = 1 << 18
# Powers up to this many are kept for the next block; those of a single longer word or text are not.
KEPT_POWERS = 1 << 21
BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below ``n``."""
    size = max(BLOCK_BYTES, 1 << max(0, n - 1).bit_length())
    found = _powers.get(size)
    if found is None:
        found = tuple(
            np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
            for base in (BASE, _BASE_INVERSE)
        )
        if size <= KEPT_POWERS:
            _powers[size] = found
    up, down = found
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """What each byte counts as: 0 for a separator, else the (lower-cased A-Z) byte."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[list(separators)] = 0
    table[0] = 0 if 0 in separators else 255
    return table


# Words between white space, as in [^\x20\x09-\x0D]+ with A-Z lower-cased.
SPACED = byte_table(b"\x20\x09\x0a\x0b\x0c\x0d")
# Words of letters, digits and all beyond ASCII, as in [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
ALNUM = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 row limits in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, limits, data = column.buffers()
    offsets = np.frombuffer(limits, np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0:
        offsets = np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def row_blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def _blocks(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Iterator[tuple[int, int]]:
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        size = BLOCK_BYTES
        while True:
            to = min(at + size, end)
            if to == end:
                break
            gaps = np.flatnonzero(table[data[at:to]] == 0)
            row = int(offsets[np.searchsorted(offsets, to, "right") - 1])
            cut = max(at + int(gaps[-1]) + 1 if len(gaps) else at, row)
            if cut > at:
                to = cut
                break
            size *= 2  # one word fills the block
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, prefixes: tuple[int, ...] = ()):
    """(start, end, row, code) of every word; with ``prefixes`` also a list of (word, code) arrays
    of the words' first bytes, one pair per length, for words longer than that."""
    starts, ends, codes = [], [], []
    heads: list[list] = [[] for _ in prefixes]
    count = 0
    for at, to in _blocks(data, offsets, table):
        seen = table[data[at:to]]
        word = seen != 0
        first = np.zeros(to - at + 1, bool)
        inside = offsets[(offsets >= at) & (offsets <= to)] - at
        first[inside] = True
        begins = word.copy()
        begins[1:] &= ~word[:-1] | first[1:-1]
        stops = word.copy()
        stops[:-1] &= ~word[1:] | first[1:-1]
        s, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        up, down = powers(to - at)
        total = np.zeros(to - at + 1, np.uint64)
        np.cumsum(seen * up, out=total[1:])
        starts.append(s + at)
        ends.append(e + at)
        codes.append(mix((total[e] - total[s]) * down[s]))
        for k, length in enumerate(prefixes):
            own = np.flatnonzero(e - s > length)
            begin = s[own]
            heads[k].append((own + count, mix((total[begin + length] - total[begin]) * down[begin] + np.uint64(length))))
        count += len(s)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start, end, code = join(starts, np.int64), join(ends, np.int64), join(codes, np.uint64)
    row = np.searchsorted(offsets, start, "right") - 1
    if not prefixes:
        return start, end, row, code
    return start, end, row, code, [(join([p[0] for p in h], np.int64), join([p[1] for p in h], np.uint64)) for h in heads]


def shingles(code: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, code) of every run of ``n`` words within a row."""
    if len(code) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = len(code) - n + 1
    total = np.full(last, n, np.uint64)
    for j in range(n):
        total = total * _STEP + code[j : last + j]
    at = np.flatnonzero(row[:last] == row[n - 1 :])
    return at, mix(total[at])
