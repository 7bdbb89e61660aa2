"""Packing of tokenised documents into fixed windows by best-fit decreasing.

Each scan task tokenises its documents, cuts full windows off the long ones, and
packs what is left, longest first, into the open window with the least sufficient
room. Windows are found through a segment tree indexed by remaining room. The
pieces of a task are packed in blocks of a bounded number of tokens, so memory is
bounded. Windows that stay far from full, a few per task, are packed once more after a
shuffle of their pieces alone, so padding does not grow with the number of tasks. A lost task
packs the same pieces again to the same windows.

Null and empty texts have no ids but the end id, so they are packed as one-token
documents. Repeated rows are packed each for itself. Equal lengths are taken in
the order of the rows. Texts of any length are tokenised whole. Further columns are not read, whatever their
names. An empty table gives no pieces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, returning
from .tokenids import unit_ids, with_end

WINDOW = 1024
END_ID = 0
# Tokens of unpacked pieces that a task holds before it packs them.
BLOCK_TOKENS = 8 << 20
# Windows filled to a smaller share than this are packed again.
FULL = 0.99

_SCHEMA = "doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class RoomTree:
    """Open windows by remaining room, under a segment tree of room counts 0..size."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = self.leaves + room
        while node:
            self.counts[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) of the tightest window with at least ``need`` room, removed; None if none."""
        node = self.leaves + need
        if not self.counts[node]:
            while node > 1 and (node & 1 or not self.counts[node ^ 1]):
                node >>= 1
            if node <= 1:
                return None
            node ^= 1
            while node < self.leaves:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.windows[room].pop()
        while node:
            self.counts[node] -= 1
            node >>= 1
        return room, window


def best_fit_decreasing(lengths: list[int], size: int) -> tuple[list[int], list[int], int]:
    """Window and offset of each piece, and the number of windows."""
    tree, window_of, offset_of, windows = RoomTree(size), [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            room, window = size, windows
            windows += 1
        else:
            room, window = found
        window_of[i], offset_of[i] = window, size - room
        if room > lengths[i]:
            tree.add(room - lengths[i], window)
    return window_of, offset_of, windows


_NAMES = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "loose")


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = (kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _NAMES)


def _placed(rest: list[tuple], size: int, sequence: int) -> tuple[list[tuple], int]:
    """Pieces with window, offset, and whether the window is far from full; and the number of windows."""
    window, offset, windows = best_fit_decreasing([p[2] for p in rest], size)
    filled = np.bincount(window, [p[2] for p in rest], windows) if rest else np.zeros(0)
    return [(*p, sequence + w, o, bool(filled[w] < FULL * size)) for p, w, o in zip(rest, window, offset)], windows


def _pack(path: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, rest, held, kind = TaskContext.get().partitionId() << 33, [], 0, None
        for batch in batches:
            docs = batch.column("doc_id")
            kind = docs.type
            for i, j, ids, counts in unit_ids(path).of_column(batch.column("text")):
                ids, counts = with_end(ids, counts, end_id)
                data, ends, full = ids.astype("<u4").tobytes(), np.cumsum(counts), []
                for doc, n, end in zip(docs.slice(i, j - i).to_pylist(), counts.tolist(), ends.tolist()):
                    first = end - n
                    for start in range(0, n - size + 1, size):
                        full.append((doc, start, size, data[4 * (first + start) : 4 * (first + start + size)], n, sequence, 0, False))
                        sequence += 1
                    if n % size:
                        start = n - n % size
                        rest.append((doc, start, n - start, data[4 * (first + start) : 4 * end], n))
                        held += n - start
                if full:
                    yield _batch(full, kind)
                if held >= BLOCK_TOKENS:
                    out, windows = _placed(rest, size, sequence)
                    sequence, rest, held = sequence + windows, [], 0
                    yield _batch(out, kind)
        if rest:
            yield _batch(_placed(rest, size, sequence)[0], kind)

    return run


def _pack_again(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, rest, kind = (1 << 62) | (TaskContext.get().partitionId() << 33), [], None
        for batch in batches:
            kind = batch.column("doc_id").type
            rest += zip(*(batch.column(c).to_pylist() for c in _NAMES[:5]))
        if rest:
            yield _batch(_placed(rest, size, sequence)[0], kind)

    return run


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, scratch: Scratch | None = None) -> DataFrame:
    """Pieces of all documents in windows of ``window`` ids.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers; ``start`` is its
    place in the document, ``offset`` its place in window ``sequence_id``.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    schema = _SCHEMA.format(kind=docs.schema["doc_id"].dataType.simpleString()) + ", loose boolean"
    packed = scratch.write(docs.select("doc_id", "text").mapInArrow(returning(_pack(tokenizer, window, end_id)), schema), "packed")
    loose = packed.where("loose")
    tasks = math.ceil((loose.agg(F.sum("length")).first()[0] or 0) / BLOCK_TOKENS)
    again = loose.repartition(max(1, tasks), "sequence_id").mapInArrow(returning(_pack_again(window)), schema)
    return packed.where("NOT loose").unionByName(again).drop("loose")


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = END_ID) -> DataFrame:
    """One row per window: its pieces' ids in order, padded unless its length is a power of two."""
    part = F.struct("offset", "ids")
    joined = F.aggregate(F.array_sort(F.collect_list(part)), F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    filled = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), joined.alias("ids"))
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    exact = F.col("n_ids").bitwiseAND(F.col("n_ids") - 1) == 0
    padding = F.array_repeat(pad, (window - F.col("n_ids")).cast("int"))
    padded = F.aggregate(padding, F.col("ids"), lambda a, x: F.concat(a, x))
    return filled.select("sequence_id", "n_ids", F.when(exact, F.col("ids")).otherwise(padded).alias("ids"))
