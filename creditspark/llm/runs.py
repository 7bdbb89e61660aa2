"""Periodic runs of words: stretches that repeat a short passage several times in a row.

For every block of documents the words become numbers that no two documents share, and an
enhanced suffix array of them is built: suffix array, its inverse, and the lengths of common
prefixes (LCP) of neighbours, all by prefix doubling. Every LCP interval of depth d is
looked at through its borders, one after the other: of the two sides that a border parts, the smaller one's
suffixes i ask whether i - d or i + d lies in the other side, which the inverse array says. If so, the two
suffixes share exactly d words, so the square that begins at the earlier one can't be moved to
the right: it ends a run of period d. Moving it to the left, by powers of two through the
ranks of prefix doubling, finds where the run starts. Squares of a multiple of a run's period give the
same stretch and merge into it. No tree is built; the work grows with n log n.

A document is worked through by one task, as its text is one row; blocks of about ``BLOCK_BYTES``
bytes bound memory besides that. A lost task repeats its documents. Nothing is shuffled.

Null, empty and word-less texts have no words and no runs. Repeated rows and null ids are rows like
others. Further columns are not read, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcodes as tc

LEAST_WORDS = 6
LEAST_PERIODS = 4
BLOCK_BYTES = 1 << 20

_SCHEMA = "doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _sorted_places(key: np.ndarray, most: int) -> np.ndarray:
    """Places in ascending order of ``key`` (0 to ``most``); equal keys in the order of places."""
    bits = max(1, (len(key) - 1).bit_length())
    if most < 1 << (62 - bits):
        packed = (key << bits) | np.arange(len(key))
        packed.sort()
        return packed & ((1 << bits) - 1)
    return np.argsort(key, kind="stable")


def suffix_order(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Suffix array, ranks by the first 1, 2, 4, ... symbols, and the round in which neighbours were told apart.

    ``ends`` holds for every place where its document ends; a suffix stops there. Documents share no symbol.
    """
    n = len(symbols)
    suffixes = _sorted_places(symbols.astype(np.int64), int(symbols.max(initial=0)))
    ordered = symbols[suffixes]
    parted = np.full(n + 1, -1, np.int8)  # round by which slot and the one before differ, -1 while they are equal
    parted[0] = parted[n] = 0
    parted[1:n][ordered[1:] != ordered[:-1]] = 0
    first = np.maximum.accumulate(np.where(parted[:n] == 0, np.arange(n), 0))
    rank = np.zeros(n, np.int32)
    rank[suffixes] = first
    ranks, width, turn = [rank], 1, 0
    open_ = np.flatnonzero((parted[:n] < 0) | (parted[1:] < 0))
    while len(open_):
        turn += 1
        places = suffixes[open_]
        follow = places + width
        second = np.where(follow < ends[places], rank[np.minimum(follow, n - 1)].astype(np.int64) + 1, 0)
        group = np.cumsum(parted[open_] >= 0)  # open slots of one group are neighbours
        order = _sorted_places(group * np.int64(n + 1) + second, (len(open_) + 1) * (n + 1))
        places, second = places[order], second[order]
        suffixes[open_] = places
        new = np.flatnonzero((second[1:] != second[:-1]) & (parted[open_[1:]] < 0)) + 1
        parted[open_[new]] = turn
        begins = parted[open_] >= 0
        rank = rank.copy()
        rank[places] = open_[np.maximum.accumulate(np.where(begins, np.arange(len(open_)), 0))]
        ranks.append(rank)
        open_ = open_[~(begins & (parted[open_ + 1] >= 0))]
        width *= 2
    return suffixes, ranks, parted


def common_prefixes(suffixes: np.ndarray, ranks: list[np.ndarray], parted: np.ndarray) -> np.ndarray:
    """Symbols that each suffix shares with the one before it; -1 at both ends."""
    n = len(suffixes)
    shared = np.zeros(n + 1, np.int32)
    border = np.flatnonzero(parted[:n] > 0)
    a, b, turn = suffixes[border - 1].astype(np.int64), suffixes[border].astype(np.int64), parted[border]
    length = np.zeros(len(border), np.int64)
    for k in range(int(turn.max(initial=0)) - 1, -1, -1):
        # Told apart in round k + 1 or later: the first 2**k symbols may be equal.
        own = np.flatnonzero(turn > k)
        x, y = a[own] + length[own], b[own] + length[own]
        inside = (x < n) & (y < n)
        same = inside & (ranks[k][np.where(inside, x, 0)] == ranks[k][np.where(inside, y, 0)])
        length[own[same]] += 1 << k
    shared[border] = length
    shared[0] = shared[n] = -1
    return shared


def _reach(shared: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last suffix of the two sides of each border: the values before are no smaller, those after are larger."""
    depth, n = shared[border], len(shared)
    least = [shared]
    widest = np.diff(np.flatnonzero(shared <= 0)).max(initial=1)
    while 2 << (len(least) - 1) <= widest:
        half = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
    low, high = border.copy(), border + 1
    for k in range(len(least) - 1, -1, -1):
        step = 1 << k
        at = low - step
        wide = (at >= 0) & (least[k][np.maximum(at, 0)] >= depth)
        low[wide] = at[wide]
        fits = high + step <= n
        wide = fits & (least[k][np.where(fits, high, 0)] > depth)
        high[wide] += step
    return low - 1, high - 1


def squares(symbols: np.ndarray, ends: np.ndarray, periods: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(place, period) of every square that can't be moved to the right and whose LCP interval has
    at least ``periods`` suffixes, and the ranks."""
    suffixes, ranks, parted = suffix_order(symbols, ends)
    shared = common_prefixes(suffixes, ranks, parted)
    n = len(symbols)
    inverse = np.zeros(n, np.int64)
    inverse[suffixes] = np.arange(n)
    border = np.flatnonzero(shared > 0)
    low, high = _reach(shared, border)
    own = high - low + 1 >= periods  # a run of so many periods has that many suffixes in the interval
    border, low, high = border[own], low[own], high[own]
    depth = shared[border].astype(np.int64)
    left = border - low <= high - border + 1  # the smaller side: low..border-1 or border..high
    begin, size = np.where(left, low, border), np.where(left, border - low, high - border + 1)
    other_low, other_high = np.where(left, border, low), np.where(left, high, border - 1)
    found, stop = [], np.cumsum(size)
    at = 0
    while at < len(border):  # in slices, so that all sides are never spread out at once
        to = max(at + 1, int(np.searchsorted(stop, (stop[at - 1] if at else 0) + (1 << 20), "right")))
        each = np.repeat(np.arange(at, to), size[at:to])
        slot = np.arange(len(each)) - np.repeat(stop[at:to] - size[at:to] - (stop[at - 1] if at else 0), size[at:to]) + begin[each]
        place, d = suffixes[slot], depth[each]
        for earlier in (True, False):
            partner = place - d if earlier else place + d
            inside = (partner >= 0) & (partner < n)
            where = inverse[np.where(inside, partner, 0)]
            hit = np.flatnonzero(inside & (where >= other_low[each]) & (where <= other_high[each]))
            found.append(np.stack([np.minimum(place, partner)[hit], d[hit]]))
        at = to
    found = np.concatenate(found, 1) if found else np.zeros((2, 0), np.int64)
    return found[0], found[1], ranks


def runs_of(symbols: np.ndarray, limits: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows (start, end, period) of all runs of at least ``least`` symbols and ``periods`` periods, by
    start and period. ``limits`` are the places where documents begin, and the end of the last one."""
    if not len(symbols):
        return np.zeros((0, 3), np.int64)
    doc = np.repeat(np.arange(len(limits) - 1), np.diff(limits))
    place, period, ranks = squares(symbols, limits[1:][doc], periods)
    begin, start = limits[:-1][doc[place]], place.copy()
    for k in range(len(ranks) - 1, -1, -1):
        # Move the square to the left while the words before both of its halves are equal.
        step = 1 << k
        at = start - step
        inside = at >= begin
        same = inside & (ranks[k][np.where(inside, at, 0)] == ranks[k][np.where(inside, at + period, 0)])
        start[same] = at[same]
    end = place + 2 * period
    good = end - start >= np.maximum(least, periods * period)
    found = np.stack([start, end, period], 1)[good]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _runs(least: int, periods: int):
    def block(texts: list[bytes | None]):
        words = [text.split() if text else [] for text in texts]  # of bytes: at ASCII white space only
        limits = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        symbols, used = np.zeros(int(limits[-1]), np.int64), 0
        for own, at, to in zip(words, limits[:-1], limits[1:]):
            numbers: dict[bytes, int] = {}
            symbols[at:to] = np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.int64, len(own)) + used
            used += len(numbers)
        found = runs_of(symbols, limits, least, periods)
        gone = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(gone, found[:, 0] + found[:, 2], 1)
        np.add.at(gone, found[:, 1], -1)
        kept = np.cumsum(gone)[:-1] == 0
        held = np.searchsorted(found[:, 0], limits)
        runs, collapsed = [], []
        for k, own in enumerate(words):
            mine = found[held[k] : held[k + 1]]
            runs.append([{"start": int(s - limits[k]), "length": int(e - s), "period": int(p)} for s, e, p in mine])
            collapsed.append(b" ".join(compress(own, kept[limits[k] : limits[k + 1]].tolist()) if len(mine) else own))
        return [len(w) for w in words], runs, collapsed

    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tc.text_bytes(batch.column("text"))
            for i, j in tc.row_blocks(offsets, BLOCK_BYTES):
                n, runs, collapsed = block([data[a:b].tobytes() for a, b in zip(offsets[i:j], offsets[i + 1 : j + 1])])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(n, pa.int64()), pa.array(runs, kind),
                     pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``runs`` (maximal stretches of at least ``least`` words and ``periods``
    times their smallest period, by start and period) and ``collapsed``: the words joined by
    one space, without those that any run has after its first period."""
    if periods < 2:
        raise ValueError("a run has at least two periods")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_runs(least, periods), _SCHEMA.format(kind=kind))
