"""Token ids of whole Arrow columns: texts are cut into units that a byte-level tokenizer treats
apart from each other, and every unit is tokenised once per worker while it is remembered.

Borders of units are borders of pre-tokens in any context: before white space that follows a
character that is none, around a single line end, and between an ASCII letter and a mark. They
are found for a block of bytes at once; where a border is in doubt, there is none.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

from . import textcodes as tc

# Units a worker remembers before it begins anew, and the longest unit it remembers, in bytes.
KNOWN_UNITS = 1 << 20
LONGEST_UNIT = 256
# Letters below are letters to every version of the character tables.
_LAST_PLAIN = "\u0250"

def _byte_characters() -> dict[int, str]:
    """The characters that byte-level vocabularies write for bytes: printable ones for
    themselves, the others counted on from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_CHARACTERS = _byte_characters()

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Sure not to be white space, or the last byte of a character that is looked at further.
_SOLID = ~_SPACE
_SOLID[0x1C:0x20] = False
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and numbers of documents that all end with the end id."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def borders(data: np.ndarray, at: int, to: int) -> np.ndarray:
    """True for every byte of ``data[at:to]`` that begins a unit; the first three bytes of the data never do."""
    found = np.zeros(to - at, bool)
    begin = max(at, 3)
    if begin >= to:
        return found
    c, p = data[begin:to], data[begin - 1 : to - 1]
    p2, p3 = data[begin - 2 : to - 2], data[begin - 3 : to - 3]
    wide = ((p2 == 0xC2) & ((p == 0x85) | (p == 0xA0))) | ((p3 == 0xE2) & ((p2 == 0x80) | (p2 == 0x81)))
    wide |= ((p3 == 0xE1) & (p2 == 0x9A)) | ((p3 == 0xE3) & (p2 == 0x80))
    begins_space = _SPACE[c] & _SOLID[p] & ~wide
    after_line = np.zeros(len(c), bool)
    after_line[1:] = begins_space[:-1] & (p[1:] == 10) & _SOLID[c[1:]] & (c[1:] < 0x80)
    found[begin - at :] = begins_space | after_line | (_MARK[c] & _LETTER[p])
    return found


def widest_id(path: str) -> int:
    """The greatest id of the tokenizer in the file."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)


class UnitIds:
    """Ids of units, remembered by 64-bit codes in an open hash table."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.forget()

    def forget(self) -> None:
        self.size = 0
        self.keys = np.zeros(4 * KNOWN_UNITS, np.uint64)
        self.place = np.zeros(4 * KNOWN_UNITS, np.int32)
        self.starts = np.zeros(KNOWN_UNITS + 1, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        return (codes >> np.uint64(20)).astype(np.int64) & (len(self.keys) - 1)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of remembered units, -1 for others."""
        slot = self._slots(codes)
        key = self.keys[slot]
        number = np.where(key == codes, self.place[slot], -1)
        open_ = np.flatnonzero((key != codes) & (key != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            key = self.keys[slot[open_]]
            hit = key == codes[open_]
            number[open_[hit]] = self.place[slot[open_[hit]]]
            open_ = open_[~hit & (key != 0)]
        return number

    def remember(self, codes: np.ndarray, ids: list[list[int]]) -> None:
        """Add distinct new units."""
        number = np.arange(self.size, self.size + len(codes), dtype=np.int32)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        ends = self.starts[self.size] + np.cumsum(lengths)
        if ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), int(ends[-1])), np.uint32)])
        self.ids[self.starts[self.size] : ends[-1]] = np.fromiter((x for one in ids for x in one), np.uint32, int(lengths.sum()))
        self.starts[self.size + 1 : self.size + 1 + len(codes)] = ends
        self.size += len(codes)
        slot, left = self._slots(codes), np.arange(len(codes))
        while len(left):
            at = slot[left]
            free = self.keys[at] == 0
            self.keys[at[free]] = codes[left[free]]
            won = self.keys[at] == codes[left]
            self.place[at[won]] = number[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)

    def encode(self, units: list[str]) -> list[list[int]]:
        """Ids per unit. Letters after at most one space are a single pre-token, which goes to the
        tokenizer's own model without its bookkeeping of offsets."""
        plain = [(u[1:] if u[0] == " " else u).isalpha() and max(u) < _LAST_PLAIN for u in units]
        others = [u for u, single in zip(units, plain) if not single]
        rest = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False) if others else ())
        return [
            [t.id for t in self.model.tokenize(u.encode().decode("latin-1").translate(_BYTE_CHARACTERS))] if single else next(rest).ids
            for u, single in zip(units, plain)
        ]

    def of_block(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive units ``data[start:end]``, and their number per unit."""
        at = int(start[0])
        seen = data[at : int(end[-1])].astype(np.uint64) + np.uint64(1)
        up, down = tc.powers(len(seen))
        total = np.zeros(len(seen) + 1, np.uint64)
        np.cumsum(seen * up, out=total[1:])
        s, length = start - at, end - start
        codes = tc.mix((total[end - at] - total[s]) * down[s] + length.astype(np.uint64)) | np.uint64(1)
        long = np.flatnonzero(length > LONGEST_UNIT)
        text = lambda i: data[start[i] : end[i]].tobytes().decode()
        number = self.find(codes)
        number[long] = -2
        missing = np.flatnonzero(number == -1)
        if len(missing):
            new, first, back = np.unique(codes[missing], return_index=True, return_inverse=True)
            if self.size + len(new) > KNOWN_UNITS:
                self.forget()
                if len(new) > KNOWN_UNITS // 2:  # more units than are ever remembered
                    half = len(start) // 2
                    parts = [self.of_block(data, start[:half], end[:half]), self.of_block(data, start[half:], end[half:])]
                    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                return self.of_block(data, start, end)
            begin = self.size
            self.remember(new, self.encode([text(i) for i in missing[first]]))
            number[missing] = begin + back
        whole = [np.array(x, np.uint32) for x in self.encode([text(i) for i in long])] if len(long) else []
        n = np.where(number >= 0, self.starts[number + 1] - self.starts[number], 0)
        n[long] = [len(x) for x in whole]
        before = np.cumsum(n) - n
        ids = self.ids[np.repeat(np.where(number >= 0, self.starts[number], 0) - before, n) + np.arange(int(n.sum()))] if not len(long) else None
        if ids is None:
            ids = np.zeros(int(n.sum()), np.uint32)
            short = np.flatnonzero(number >= 0)
            spread = np.arange(int(n[short].sum())) - np.repeat(np.cumsum(n[short]) - n[short], n[short])
            ids[np.repeat(before[short], n[short]) + spread] = self.ids[np.repeat(self.starts[number[short]], n[short]) + spread]
            for i, x in zip(long, whole):
                ids[before[i] : before[i] + len(x)] = x
        return ids, n

    def of_rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and their number per row."""
        parts, counts = [], np.zeros(len(offsets) - 1, np.int64)
        at, end = int(offsets[0]), int(offsets[-1])
        while at < end:
            size = tc.BLOCK_BYTES
            while True:
                to = min(at + size, end)
                first = borders(data, at, to)
                inside = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to)]
                first[inside - at] = True
                first[0] = True
                start = np.flatnonzero(first) + at
                if to == end or len(start) > 1:
                    break
                size *= 2  # one unit fills the block
            limit = np.append(start, to) if to == end else start
            ids, n = self.of_block(data, limit[:-1], limit[1:])
            row = np.searchsorted(offsets, limit[:-1], "right") - 1
            counts += np.bincount(row, weights=n, minlength=len(counts)).astype(np.int64)
            parts.append(ids)
            at = int(limit[-1])
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), counts

    def of_column(self, column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(i, j, ids, counts)`` for row ranges of bounded size; null is empty."""
        data, offsets = tc.text_bytes(column)
        for i, j in tc.row_blocks(offsets, tc.BLOCK_BYTES):
            yield i, j, *self.of_rows(data, offsets[i : j + 1])


_workers: dict[str, UnitIds] = {}


def unit_ids(path: str) -> UnitIds:
    """The tokenizer of this worker process."""
    if path not in _workers:
        _workers[path] = UnitIds(path)
    return _workers[path]
