"""Canonical length-limited Huffman codes of token ids, in blocks with bit-offset checkpoints.

Only the code lengths are kept; codes follow from them in the order of (length, id). An
encoded run of ids is a header, the bit offset of every block of ``BLOCK_IDS`` ids, and the
bits, highest first. A block is decoded from its offset alone, through a table over the
next ``longest`` bits; all blocks of a run advance by one id per step.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK_IDS = 256
LONGEST = 24
_MAGIC = b"HID1"
_HEADER = struct.Struct("<4sIQQ")  # magic, ids per block, ids, bits


def code_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Optimal lengths of at most ``longest`` bits by package-merge; 0 for ids that never occur.

    The order of equal counts is that of the ids. A single id gets one bit.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids don't fit {longest} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64 if counts.sum() > 1 << 50 else np.int64)
    merged, is_leaf = weights, [np.ones(len(used), bool)]
    for _ in range(longest - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        merged = both[order]
        is_leaf.append(order < len(weights))
    take, found = 2 * len(used) - 2, np.zeros(len(used), np.uint8)
    for leaf in reversed(is_leaf):
        own = int(leaf[:take].sum())
        found[:own] += 1
        take = 2 * (take - own)
    lengths[used] = found
    return lengths


class Codec:
    """Encoder and decoder of one set of code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, np.uint8)
        self.longest = int(self.lengths.max(initial=1))
        used = np.flatnonzero(self.lengths)
        used = used[np.argsort(self.lengths[used], kind="stable")]
        size = self.lengths[used].astype(np.int64)
        # In canonical order the codes, aligned to the longest, are running sums of their shares.
        share = np.int64(1) << (self.longest - size)
        first = np.cumsum(share) - share
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[used] = (first >> (self.longest - size)).astype(np.uint64)
        self.table = np.zeros(1 << self.longest, np.uint32)
        if len(used):
            self.table[: int(share.sum())] = np.repeat((used.astype(np.uint32) << np.uint32(5)) | size.astype(np.uint32), share)

    def encode(self, ids: np.ndarray) -> bytes:
        size = self.lengths[ids].astype(np.int64)
        if len(ids) and not size.all():
            raise ValueError("an id without a code")
        end = np.cumsum(size)
        at = end - size
        bits = int(end[-1]) if len(ids) else 0
        words = np.zeros(bits // 32 + 3, np.uint64)
        if len(ids):
            # Each code lies in one or two 32-bit words, and every word but a last one has a code that begins there.
            word = at >> 5
            wide = self.codes[ids] << (64 - size - (at & 31)).astype(np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            own = word[starts]
            words[own] += np.add.reduceat(wide >> np.uint64(32), starts)
            words[own + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), starts)
        head = _HEADER.pack(_MAGIC, BLOCK_IDS, len(ids), bits)
        return head + at[::BLOCK_IDS].astype("<u8").tobytes() + words.astype(">u4").tobytes()

    def decode(self, data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids ``first`` to ``last`` (exclusive) of an encoded run; only blocks that hold them are decoded."""
        magic, per_block, n, bits = _HEADER.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not an encoded run of ids")
        last = n if last is None else min(last, n)
        if first >= last:
            return np.zeros(0, np.uint32)
        blocks = -(-n // per_block)
        offsets = np.frombuffer(data, "<u8", blocks, _HEADER.size).astype(np.int64)
        begin, end = first // per_block, -(-last // per_block)
        at = offsets[begin:end].copy()
        words = np.frombuffer(data, ">u4", offset=_HEADER.size + 8 * blocks)
        low = int(at[0]) >> 5
        high = (int(offsets[end]) if end < blocks else bits) // 32 + 3
        words = words[low:high].astype(np.uint64)
        wide = (words[:-1] << np.uint64(32)) | words[1:]
        at -= low << 5
        out = np.zeros((per_block, len(at)), np.uint32)
        shift, mask = 64 - self.longest, np.uint64((1 << self.longest) - 1)
        whole = n // per_block - begin  # blocks that are full
        for k in range(per_block):
            if k == n % per_block and whole < len(at):
                at = at[:whole]  # the last block ends here
            if not len(at):
                break
            look = (wide[at >> 5] >> (shift - (at & 31)).astype(np.uint64)) & mask
            entry = self.table[look]
            out[k, : len(at)] = entry >> np.uint32(5)
            at = at + (entry & np.uint32(31)).astype(np.int64)
        return out.T.reshape(-1)[first - begin * per_block : last - begin * per_block]
