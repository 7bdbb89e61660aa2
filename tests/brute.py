"""Slow, direct versions of the statistics, for comparison on small frames."""

from __future__ import annotations

import math

import numpy as np


def tree_bins(values, labels, k: int, min_share: float = 0.05):
    """Leaves of the best-first gini tree as (low, high, n, bad) in value order."""
    values, labels = np.asarray(values, float), np.asarray(labels, int)
    order = np.argsort(values, kind="stable")
    x, y = values[order], labels[order]
    small = math.ceil(min_share * len(x))

    def purity(part):
        bad = float(part.sum())
        good = float(len(part)) - bad
        return (bad * bad + good * good) / len(part)

    def best(start, end):
        part = y[start:end]
        if part.sum() in (0, len(part)):
            return None
        found = None
        for cut in range(start + small, end - small + 1):
            if cut in (start, end) or x[cut - 1] == x[cut]:
                continue
            gain = purity(y[start:cut]) + purity(y[cut:end]) - purity(part)
            if found is None or gain > found[0]:
                found = (gain, cut)
        return found

    leaves = [(0, len(x), best(0, len(x)))]
    while len(leaves) < k:
        open_leaves = [leaf for leaf in leaves if leaf[2]]
        if not open_leaves:
            break
        leaf = max(open_leaves, key=lambda l: (l[2][0], -l[0]))
        leaves.remove(leaf)
        start, end, (_, cut) = leaf
        leaves += [(start, cut, best(start, cut)), (cut, end, best(cut, end))]
    return [(x[s], x[e - 1], e - s, int(y[s:e].sum())) for s, e, _ in sorted(leaves)]


def woe_and_iv(bins):
    goods, bads = sum(n - b for _, _, n, b in bins), sum(b for _, _, _, b in bins)
    woes, total = [], 0.0
    for _, _, n, bad in bins:
        g, b = max((n - bad) / goods, 1e-6), max(bad / bads, 1e-6)
        woe = min(5.0, max(-5.0, math.log(g / b)))
        woes.append(woe)
        total += (g - b) * woe
    return woes, total


def psi(base, actual, bins: int = 10) -> float:
    base = np.asarray([v for v in base if v is not None and not np.isnan(v)], float)
    actual = np.asarray([v for v in actual if v is not None and not np.isnan(v)], float)
    if not len(base) or not len(actual):
        return 0.0
    edges = np.percentile(base, [100 * i / bins for i in range(1, bins)])
    total = 0.0
    for i in range(bins):
        def share(v):
            return max(float(np.mean(np.searchsorted(edges, v, side="right") == i)), 1e-6)

        e, a = share(base), share(actual)
        total += (a - e) * math.log(a / e)
    return total


def auc(labels, scores) -> float:
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def ks(labels, scores) -> float:
    labels, scores = np.asarray(labels), np.asarray(scores)
    return max(
        [0.0]
        + [float(np.mean(scores[labels == 1] >= t) - np.mean(scores[labels == 0] >= t)) for t in np.unique(scores)]
    )


def average_precision(labels, scores) -> float:
    labels, scores = np.asarray(labels), np.asarray(scores)
    total, before = 0.0, 0.0
    for t in sorted(np.unique(scores), reverse=True):
        chosen = scores >= t
        recall = labels[chosen].sum() / labels.sum()
        total += (recall - before) * labels[chosen].mean()
        before = recall
    return total
