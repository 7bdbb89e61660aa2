"""Tree-structured Parzen estimation: which parameters to try next, given finished trials.

Finished trials are parted into the best tenth and the rest. For each parameter both parts give a
density: a mixture of normal curves around the values tried, cut off at the range, besides one
wide curve over the whole range. Values are drawn from the density of the best, and the one is
taken where that density is highest against that of the rest. The first trials are
drawn from the whole range. Trials that are proposed together count each other as bad, so they differ.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

STARTUP = 10
CANDIDATES = 24
BEST_SHARE = 0.1
MOST_BEST = 25


@dataclass(frozen=True)
class Space:
    """Range of a parameter; ``whole`` numbers include both ends, ``logarithmic`` ones are looked at as logarithms."""

    low: float
    high: float
    whole: bool = False
    logarithmic: bool = False

    @property
    def limits(self) -> tuple[float, float]:
        """Ends of the range as densities see it; a whole number stands for the stretch around it."""
        half = 0.5 if self.whole else 0.0
        low, high = self.low - half, self.high + half
        return (math.log(low), math.log(high)) if self.logarithmic else (low, high)

    def inner(self, value: float) -> float:
        return math.log(value) if self.logarithmic else float(value)

    def outer(self, inner: float) -> float | int:
        value = math.exp(inner) if self.logarithmic else inner
        value = min(max(value, self.low), self.high)
        return int(min(max(round(value), self.low), self.high)) if self.whole else value


@dataclass(frozen=True)
class Mixture:
    """Normal curves of equal weight, cut off at ``low`` and ``high``."""

    centre: np.ndarray
    width: np.ndarray
    low: float
    high: float

    def _mass(self) -> np.ndarray:
        upto = lambda x: np.array([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in x])
        return upto((self.high - self.centre) / self.width) - upto((self.low - self.centre) / self.width)

    def density(self, x: Sequence[float]) -> np.ndarray:
        z = (np.asarray(x, float)[:, None] - self.centre) / self.width
        curves = np.exp(-z * z / 2) / (self.width * math.sqrt(2 * math.pi)) / self._mass()
        return curves.mean(1)

    def draw(self, generator: random.Random) -> float:
        k = generator.randrange(len(self.centre))
        while True:  # a curve's centre lies in the range, so about half of the draws do at least
            value = generator.gauss(self.centre[k], self.width[k])
            if self.low <= value <= self.high:
                return value


def mixture(values: Sequence[float], low: float, high: float) -> Mixture:
    """A curve per value, as wide as the larger gap to its neighbours (ends of the range included), and one over the range.

    Widths are at least the range over ``min(100, curves)``.
    """
    span = high - low
    centre = np.array([*values, (low + high) / 2], float)
    order = np.argsort(centre, kind="stable")
    edges = np.concatenate([[low], centre[order], [high]])
    width = np.zeros(len(centre))
    width[order] = np.maximum(edges[1:-1] - edges[:-2], edges[2:] - edges[1:-1])
    width = np.clip(width, span / min(100, 1 + len(centre)), span)
    width[-1] = span
    return Mixture(centre, width, low, high)


def parted(finished: Sequence[tuple], least: int = 1) -> tuple[list[dict], list[dict]]:
    """Parameters of the best trials and of the others, by the value in the second place; ties to the earlier trial."""
    order = sorted(range(len(finished)), key=lambda i: (-finished[i][1], i))
    best = min(max(least, math.ceil(BEST_SHARE * len(finished))), MOST_BEST)
    return [finished[i][0] for i in order[:best]], [finished[i][0] for i in order[best:]]


def propose_one(space: dict[str, Space], finished: Sequence[tuple], generator: random.Random) -> dict:
    if len(finished) < STARTUP:
        return {name: s.outer(generator.uniform(*s.limits)) for name, s in space.items()}
    good, rest = parted(finished)
    drawn = {}
    for name, s in space.items():
        low, high = s.limits
        better = mixture([s.inner(d[name]) for d in good], low, high)
        worse = mixture([s.inner(d[name]) for d in rest], low, high)
        tried = [better.draw(generator) for _ in range(CANDIDATES)]
        ratio = np.log(better.density(tried)) - np.log(worse.density(tried))
        drawn[name] = s.outer(tried[int(ratio.argmax())])
    return drawn


def propose(space: dict[str, Space], finished: Sequence[tuple], count: int, generator: random.Random) -> list[dict]:
    """``count`` parameter sets to try at once after ``finished`` (parameters, value, ...) trials."""
    drawn: list[dict] = []
    for _ in range(count):
        pending = [(d, -math.inf) for d in drawn]
        drawn.append(propose_one(space, [*finished, *pending], generator))
    return drawn
