"""Leaf-wise boosting on binned features: many models grown in the same scans of one stored table.

Each row carries its bins and, as bits of three numbers, which models train on it, which are
validated on it, and its label in each model. A pass over the table sums gradients, hessians and
rows per (model, node, feature, bin) for all open nodes of all models; Spark adds up the
sums of the tasks, and the driver, which sees a table bounded by models x leaves x
features x bins, picks the splits. Sums are whole numbers of 2**-24, so they don't depend on
the order of rows or tasks, and a repeated task changes nothing.

A tree takes one pass per two levels while the sums of all pairs of its features are few: those of a node and
a pair give the sums of both sides of any split of the node by one of the two features. Otherwise a pass
brings sums per feature, for one level. A pass looks only at nodes that the best-first order could
still reach with the leaves that are left, so the tree is the one that grows leaf by leaf.
Rows are stored in blocks, whose columns are the bytes of arrays: a pass reads them without turning rows
into columns. Scores are stored with them every ``STORE_ROUNDS`` rounds; between, a pass adds the trees since then.
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.storage import removed, written_at

UNIT = float(1 << 24)
STORE_ROUNDS = 10
# Rows of a stored block.
BLOCK = 50_000
BLOCK_COLUMNS = ("row_id", "bins", "trains", "held", "label", "score")
BLOCKS_PER_TASK = 4
# Blocks that readers hold at a time.
FEW_BLOCKS = 4
MAX_MODELS = 62
FEW_TASKS = 32
# Sums of pairs that a pass may bring; pairs are worth their work up to so many per feature.
PAIR_CELLS = 400_000
PAIRS_PER_FEATURE = 3
# Two features have a table side by side up to this size; leaves whose bits fit a number.
JOINT_CELLS = 1 << 14
BIT_LEAVES = 62

_SUMS = "model int, part int, node int, sums binary"


@dataclass(frozen=True)
class Settings:
    """What a model is grown with. ``leaves=None`` bounds trees by their depth only."""

    rounds: int = 100
    rate: float = 0.1
    depth: int = 6
    leaves: int | None = None
    least_rows: int = 1
    least_hessian: float = 1e-3
    row_share: float = 1.0
    feature_share: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    least_gain: float = 0.0
    bad_weight: float = 1.0
    patience: int | None = None
    seed: int = 42


@dataclass
class Tree:
    """Nodes as parallel lists; ``feature`` is -1 in a leaf. Bins up to ``limit`` go left, bin 0 (missing) by ``missing_left``."""

    feature: list[int] = field(default_factory=list)
    limit: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)

    def add(self, value: float, rows: int) -> int:
        for name, x in (("feature", -1), ("limit", 0), ("missing_left", False), ("left", -1), ("right", -1), ("value", value), ("gain", 0.0), ("rows", rows)):
            getattr(self, name).append(x)
        return len(self.feature) - 1


class _Rows:
    """Bins of rows as places in tables of two neighbouring features, or of one if ``width`` bins are many."""

    def __init__(self, bins: np.ndarray, width: int):
        self.bins, self.width, self._places, self._wide = bins, width, {}, {}

    def wide(self, feature: int) -> np.ndarray:
        if feature not in self._wide:
            self._wide[feature] = self.bins[feature].astype(np.intp)
        return self._wide[feature]

    def places(self, group: tuple[int, ...]) -> np.ndarray:
        if group not in self._places:
            self._places[group] = self.wide(group[0]) if len(group) == 1 else self.wide(group[0]) * self.width + self.wide(group[1])
        return self._places[group]

    def part(self, own: np.ndarray) -> _Rows:
        return _Rows(self.bins[:, own], self.width)


class _Walk:
    """Finds the leaves of rows. Leaves are bits from left to right; a table per feature, or per two of them, says which leaves
    a bin leaves open. One bit is open in all tables: that of the row's leaf. Larger trees are split first."""

    def __init__(self, tree: Tree, features: int, width: int, node: int = 0):
        self.ends, splits = [], []

        def bits(at: int) -> int:
            if tree.feature[at] < 0:
                self.ends.append(at)
                return 1 << (len(self.ends) - 1)
            left, right = bits(tree.left[at]), bits(tree.right[at])
            splits.append((at, left, right))
            return left | right

        every = bits(node)
        if len(self.ends) == 1:
            return
        if len(self.ends) > BIT_LEAVES:
            self.goes, self.feature = _goes_left(tree, node, width), tree.feature[node]
            self.sides = [_Walk(tree, features, width, side) for side in (tree.left[node], tree.right[node])]
            return
        single, side_by_side = {}, width * width <= JOINT_CELLS
        for at, left, right in splits:
            table = single.setdefault(tree.feature[at], np.full(width, every))
            table &= np.where(_goes_left(tree, at, width), ~right, ~left)
        self.tables = {}
        for f in sorted(single):
            if side_by_side and f % 2 and f - 1 in single:
                self.tables[f - 1, f] = (self.tables.pop((f - 1,))[:, None] & single[f]).ravel()
            else:
                self.tables[f,] = single[f]

    def __call__(self, rows: _Rows, of_node: np.ndarray) -> np.ndarray:
        """What ``of_node`` says of the node at which every row ends."""
        if len(self.ends) == 1:
            return np.full(rows.bins.shape[1], of_node[self.ends[0]])
        if len(self.ends) > BIT_LEAVES:
            return np.where(self.goes.take(rows.wide(self.feature)), *(side(rows, of_node) for side in self.sides))
        left = None
        for group, table in self.tables.items():
            found = table.take(rows.places(group))
            left = found if left is None else np.bitwise_and(left, found, out=left)
        # The place of the bit is the exponent of the number as a double.
        of_end = np.concatenate([np.zeros(1023, of_node.dtype), of_node[self.ends]])
        return of_end.take(left.astype(float).view(np.int64) >> 52)


def _goes_left(tree: Tree, node: int, width: int) -> np.ndarray:
    """Per bin of the node's feature."""
    goes = np.arange(width) <= tree.limit[node]
    goes[0] = tree.missing_left[node]
    return goes


def raw_scores(trees: Sequence[Tree], bins: np.ndarray) -> np.ndarray:
    """The sum of the trees' values for every row; ``bins`` is features x rows."""
    width = int(bins.max(initial=0)) + 1
    walks = [_Walk(tree, len(bins), width) for tree in trees]
    total = np.zeros(bins.shape[1])
    for start in range(0, bins.shape[1], BLOCK):
        total[start : start + BLOCK] = _scores(trees, walks, _Rows(bins[:, start : start + BLOCK], width))
    return total


def _scores(trees: Sequence[Tree], walks: Sequence[_Walk], rows: _Rows) -> np.ndarray:
    total = np.zeros(rows.bins.shape[1])
    for tree, walk in zip(trees, walks):
        total += walk(rows, np.array(tree.value))
    return total


def bins_of(column: pa.Array, features: int) -> np.ndarray:
    """Lists of equal length as a features x rows matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), features).T)


def _packed(features: int, bins: int, start: Sequence[float], most: int):
    """Blocks of up to ``most`` rows, a block per row of the new table: its columns are the bytes of arrays, which later passes read as they are.
    Ids that count up are stored as the first one, equal bits of all rows as one."""

    def block(rows: pa.Table) -> pa.RecordBatch:
        arrays = {c: rows.column(c).to_numpy().astype(np.int64) for c in ("row_id", "trains", "held", "label")}
        ids = arrays["row_id"]
        if (np.diff(ids) == 1).all():
            arrays["row_id"] = ids[:1]
        for c in ("trains", "held", "label"):
            arrays[c] = arrays[c].astype(_bit_kind(len(start)))
        for c in ("trains", "held"):
            if (arrays[c] == arrays[c][0]).all():
                arrays[c] = arrays[c][:1]
        arrays["bins"] = bins_of(rows.column("bins"), features).astype(_kind(bins))
        arrays["score"] = np.repeat(np.array(start, float)[:, None], len(rows), 1)
        return pa.RecordBatch.from_arrays([pa.array([arrays[c].tobytes()], pa.binary()) for c in BLOCK_COLUMNS], list(BLOCK_COLUMNS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            for at in range(0, len(batch), most):
                part = batch.slice(at, most)
                if rows + len(part) > most:
                    yield block(pa.Table.from_batches(waiting))
                    waiting, rows = [], 0
                waiting.append(part)
                rows += len(part)
        if rows:
            yield block(pa.Table.from_batches(waiting))

    return run


def _kind(bins: int) -> type:
    return np.uint8 if bins <= 256 else np.int16


def _bit_kind(models: int) -> type:
    return np.uint8 if models <= 8 else np.uint16 if models <= 16 else np.int64


def _blocks(batches: Iterator[pa.RecordBatch], features: int, bins: int, models: int) -> Iterator[dict[str, np.ndarray]]:
    """The arrays of each block: ``bins`` is features x rows, ``score`` models x rows; ``trains`` and ``held`` may have one entry for all rows."""
    for batch in batches:
        for i in range(len(batch)):
            raw = {c: batch.column(c)[i].as_buffer() for c in BLOCK_COLUMNS}
            block = {c: np.frombuffer(raw[c], _bit_kind(models)) for c in ("trains", "held", "label")}
            n = len(block["label"])
            ids = np.frombuffer(raw["row_id"], np.int64)
            block["row_id"] = ids if len(ids) == n else np.arange(ids[0], ids[0] + n)
            block["bins"] = np.frombuffer(raw["bins"], _kind(bins)).reshape(features, n)
            block["score"] = np.frombuffer(raw["score"]).reshape(models, n)
            yield block


def _where(bits: np.ndarray, number: int, rows: int) -> np.ndarray:
    """Per row whether the bit is set."""
    return np.broadcast_to(((bits >> number) & 1).astype(bool), rows)


@contextmanager
def _few_blocks(spark: SparkSession) -> Iterator[None]:
    """Readers and batches to Python hold a few blocks at a time."""
    names = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, str(FEW_BLOCKS))
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def chosen_rows(ids: np.ndarray, seed: int, turn: int, share: float) -> np.ndarray:
    """Rows of a round, by a hash of their ids."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + turn) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(min(int(share * 2.0**64), (1 << 64) - 1))


@dataclass
class Model:
    """A finished or growing model. Scores of rows start at ``base`` (log odds)."""

    number: int
    settings: Settings
    features: int
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)  # on validation rows, after each tree
    best: int = 0  # place of the lowest loss
    stored: int = 0  # trees that the stored scores contain
    done: bool = False
    tree: Tree | None = None  # the growing one, with all splits known
    splits: dict = field(default_factory=dict)  # node -> best split, or None where there is none
    depths: list[int] = field(default_factory=list)
    open: list[int] = field(default_factory=list)  # nodes whose sums the next pass brings
    allowed: list[int] = field(default_factory=list)

    def begin_tree(self) -> None:
        """Start a tree, or only ask for the loss once all rounds are done."""
        self.open = []
        if len(self.trees) < self.settings.rounds:
            self.tree, self.splits, self.depths, self.open = Tree(), {}, [0], [0]
            self.tree.add(0.0, 0)
            draw = random.Random(self.settings.seed * 1_000_003 + len(self.trees))
            self.allowed = sorted(draw.sample(range(self.features), max(1, math.ceil(self.settings.feature_share * self.features))))

    def wants_loss(self) -> bool:
        return self.settings.patience is not None and len(self.losses) < len(self.trees) and self.open in ([], [0])

    def learn(self, node: int, sums: np.ndarray) -> None:
        """Note the best split of a node from its (features, bins, 3) sums; its sides become nodes."""
        s, tree = self.settings, self.tree
        if node == 0:
            g, h, n = sums[self.allowed[0]].sum(0)
            tree.value[0], tree.rows[0] = leaf_value(g, h, s), int(n)
        split = self.splits[node] = best_split(sums, self.allowed, s)
        if split is None:
            return
        sides = [tree.add(leaf_value(g, h, s), int(n)) for g, h, n in split["sides"]]
        tree.feature[node], tree.limit[node], tree.missing_left[node] = split["feature"], split["limit"], split["missing_left"]
        tree.gain[node], (tree.left[node], tree.right[node]) = split["gain"], sides
        for side in sides:
            self.depths.append(self.depths[node] + 1)
            if self.depths[side] >= s.depth or tree.rows[side] < 2 * s.least_rows:
                self.splits[side] = None

    def advance(self) -> None:
        """Walk best-first through the known splits. ``open`` become the nodes that could still change
        which splits are taken; without any, the tree is complete."""
        tree, most = self.tree, self.settings.leaves or math.inf
        taken, unknown, ready = [], [], []
        if self.splits[0]:
            ready.append((-tree.gain[0], 0))
        while ready and len(taken) + 1 < most:
            _, node = heapq.heappop(ready)
            for side in (tree.left[node], tree.right[node]):
                if side not in self.splits:
                    unknown.append((len(taken), side))
                elif self.splits[side]:
                    heapq.heappush(ready, (-tree.gain[side], side))
            taken.append(node)
        # A side of the last split taken has no say once all leaves are used up.
        room = len(taken) + 1 < most
        self.open = [side for turn, side in unknown if room or turn < len(taken) - 1]
        if not self.open:
            self.trees.append(_pruned(tree, set(taken)))
            self.tree = None

    def lost(self, loss: float) -> None:
        """Note the validation loss with all trees so far; stop when it has not fallen for long."""
        self.losses.append(loss)
        if loss < self.losses[self.best]:
            self.best = len(self.losses) - 1
        elif len(self.losses) - 1 - self.best >= self.settings.patience:
            self.done = True


def _pruned(tree: Tree, taken: set[int]) -> Tree:
    """The part of a tree that the taken splits make."""
    kept = Tree()

    def copy(node: int) -> int:
        at = kept.add(tree.value[node], tree.rows[node])
        if node in taken:
            kept.feature[at], kept.limit[at], kept.missing_left[at], kept.gain[at] = (
                tree.feature[node], tree.limit[node], tree.missing_left[node], tree.gain[node]
            )
            kept.left[at], kept.right[at] = copy(tree.left[node]), copy(tree.right[node])
        return at

    copy(0)
    return kept


def shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def leaf_value(g: float, h: float, s: Settings) -> float:
    g, h = g / UNIT, h / UNIT
    return float(-s.rate * shrunk(g, s.l1) / (h + s.l2)) if h + s.l2 > 0 else 0.0


def best_split(sums: np.ndarray, allowed: Sequence[int], s: Settings) -> dict | None:
    """The split with the greatest gain; ties go to the first feature, missing to the right, the lowest limit."""

    def strength(g, h):
        h = h + s.l2
        return np.where(h > 0, shrunk(g, s.l1) ** 2 / np.where(h > 0, h, 1), 0)

    best = None
    for f in allowed:
        table = sums[f]
        total = table.sum(0)
        whole = strength(*(total[:2] / UNIT))
        ahead = np.cumsum(table[1:], 0)  # bins 1..i go left
        for missing_left in (False, True):
            if missing_left and not table[0, 2]:
                continue
            left = ahead + (table[0] if missing_left else 0)
            right = total - left
            ok = (left[:, 2] >= max(1, s.least_rows)) & (right[:, 2] >= max(1, s.least_rows))
            ok &= (left[:, 1] >= s.least_hessian * UNIT) & (right[:, 1] >= s.least_hessian * UNIT)
            gain = strength(left[:, 0] / UNIT, left[:, 1] / UNIT) + strength(right[:, 0] / UNIT, right[:, 1] / UNIT) - whole
            gain = np.where(ok, gain, -np.inf)
            at = int(gain.argmax()) if len(gain) else 0
            if len(gain) and gain[at] > max(s.least_gain, 1e-12) and (best is None or gain[at] > best["gain"]):
                best = dict(feature=f, limit=at + 1, missing_left=missing_left, gain=float(gain[at]), sides=(left[at], right[at]))
    return best


def _plan(model: Model, parts: list[tuple[int, ...]]) -> dict:
    """What a task needs to know of a model for one pass; ``parts`` are the features, or pairs of them, whose sums it brings."""
    return dict(
        number=model.number, s=model.settings, trees=model.trees[model.stored :], turn=len(model.trees), tree=model.tree,
        open=model.open, parts=parts, loss=model.wants_loss(),
    )


def _parts(models: Sequence[Model], bins: int) -> list[list[tuple[int, ...]]]:
    """Per model the features or pairs whose sums a pass brings: pairs where they tell of a second level and are few in all models together."""
    chosen, cells = [], 0
    for m in models:
        pairs = list(combinations(m.allowed, 2))
        deep = [node for node in m.open if m.depths[node] + 1 < m.settings.depth]
        chosen.append(pairs if deep and 0 < len(pairs) <= PAIRS_PER_FEATURE * len(m.allowed) else [])
        cells += len(chosen[-1]) * len(m.open) * bins * bins
    return [pairs if pairs and cells <= PAIR_CELLS else [(f,) for f in m.allowed] for m, pairs in zip(models, chosen)]


def _slopes(scores: np.ndarray, labels: np.ndarray, bad_weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and hessians in whole units; ``scores`` is used up."""
    chance = np.clip(scores, -700, 700, out=scores)
    np.exp(np.negative(chance, out=chance), out=chance)
    chance += 1
    np.reciprocal(chance, out=chance)
    g, h = chance - labels, 1 - chance
    h *= chance
    if bad_weight != 1:
        weight = np.where(labels > 0, bad_weight, 1.0)
        g *= weight
        h *= weight
    for x in (g, h):
        x *= UNIT
        np.rint(x, out=x)
    return g, h


def _sums(plans: list[dict], features: int, bins: int, models: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per model and part: (g, h and n) x (open nodes x bins, or pairs of bins).
        total = [[np.zeros((3, len(p["open"]) * bins ** len(part)), np.int64) for part in p["parts"]] for p in plans]
        losses = np.zeros((len(plans), 2), np.int64)
        walks = [[_Walk(tree, features, bins) for tree in p["trees"]] for p in plans]
        growing = [_Walk(p["tree"], features, bins) if p["open"] else None for p in plans]
        for block in _blocks(batches, features, bins, models):
            label, score, rows = block["label"], block["score"], len(block["label"])
            for k, p in enumerate(plans):
                number, s = p["number"], p["s"]
                if p["loss"]:
                    seen = np.flatnonzero(_where(block["held"], number, rows))
                    if len(seen):
                        now = score[number].take(seen) + _scores(p["trees"], walks[k], _Rows(block["bins"][:, seen], bins))
                        z = np.where((label.take(seen) >> number) & 1, -now, now)
                        losses[k] += np.rint(np.logaddexp(0, z) * UNIT).astype(np.int64).sum(), len(seen)
                if not p["open"]:
                    continue
                mine = _where(block["trains"], number, rows)
                if s.row_share < 1 and mine.any():
                    mine = mine & chosen_rows(block["row_id"], s.seed, p["turn"], s.row_share)
                own = np.flatnonzero(mine)
                if not len(own):
                    continue
                x = _Rows(block["bins"][:, own], bins)
                slot = np.full(len(p["tree"].feature), -1)
                slot[p["open"]] = np.arange(len(p["open"]))
                at = growing[k](x, slot)
                if at.min() < 0:
                    inside = np.flatnonzero(at >= 0)
                    if not len(inside):
                        continue
                    own, at, x = own.take(inside), at.take(inside), x.part(inside)
                now = score[number].take(own)
                if p["trees"]:
                    now += _scores(p["trees"], walks[k], x)
                g, h = _slopes(now, (label.take(own) >> number) & 1, s.bad_weight)
                for sums, part in zip(total[k], p["parts"]):
                    cell = at
                    for f in part:
                        cell = cell * bins + x.wide(f)
                    for j, w in enumerate((g, h, None)):
                        # Whole numbers below 2**53, whose sums are exact.
                        found = np.bincount(cell, weights=w, minlength=sums.shape[1])
                        np.add(sums[j], found, out=sums[j], casting="unsafe")
        out = []
        for k, p in enumerate(plans):
            for i, sums in enumerate(total[k]):
                for j, node in enumerate(p["open"]):
                    cells = bins ** len(p["parts"][i])
                    out.append((p["number"], i, node, sums[:, j * cells : (j + 1) * cells].tobytes()))
            if losses[k, 1]:
                out.append((p["number"], -1, -1, losses[k].tobytes()))
        if out:
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["model", "part", "node", "sums"])

    return run


def _with_scores(trees: dict[int, list[Tree]], features: int, bins: int, models: int):
    """Add trees to the stored scores of their models."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = {number: [_Walk(tree, features, bins) for tree in some] for number, some in trees.items()}
        for batch in batches:
            scores = []
            for block in _blocks([batch], features, bins, models):
                score, rows = block["score"].copy(), _Rows(block["bins"], bins)
                for number, some in trees.items():
                    score[number] += _scores(some, walks[number], rows)
                scores.append(score.tobytes())
            yield batch.set_column(batch.schema.get_field_index("score"), "score", pa.array(scores, pa.binary()))

    return run


def _summed(found: pa.Table) -> dict[tuple[int, int, int], np.ndarray]:
    """The sums per (model, part, node), added up."""
    total = {}
    for model, part, node, raw in zip(*(found.column(c).to_pylist() for c in ("model", "part", "node")), found.column("sums")):
        sums = np.frombuffer(raw.as_buffer(), np.int64)
        key = model, part, node
        if key in total:
            total[key] += sums
        else:
            total[key] = sums.copy()
    return total


def _summed_table(found: pa.Table) -> pa.Table:
    total = _summed(found)
    keys = [pa.array(c, pa.int32()) for c in zip(*total)]
    return pa.table([*keys, pa.array([x.tobytes() for x in total.values()], pa.binary())], ["model", "part", "node", "sums"])


def _added(partial: DataFrame, tasks: int) -> dict[tuple[int, int, int], np.ndarray]:
    """Sums per (model, part, node) over all tasks, a table bounded by models x open nodes x features x bins, or by ``PAIR_CELLS``.

    The few tables of up to ``FEW_TASKS`` tasks are added up here, which saves a shuffle per pass. Exact at any number of rows.
    """
    if tasks > FEW_TASKS:
        partial = partial.groupBy("model", "part", "node").applyInArrow(_summed_table, _SUMS)
    return _summed(partial.toArrow())


def _started(models: list[Model], table: DataFrame) -> int:
    """Find the scores to start from; a model with labels of one kind only stays without trees. The number of rows is returned."""
    bit = lambda c, k: F.shiftright(c, k).bitwiseAND(F.lit(1))
    counts = table.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(bit("trains", m.number)).alias(f"n{m.number}") for m in models],
        *[F.sum(bit("trains", m.number) * bit("label", m.number)).alias(f"y{m.number}") for m in models],
    ).first()
    for m in models:
        n, bad = counts[f"n{m.number}"] or 0, counts[f"y{m.number}"] or 0
        m.done = not 0 < bad < n or m.settings.rounds < 1
        m.base = math.log(bad * m.settings.bad_weight / (n - bad)) if 0 < bad < n else 20.0 if bad else -20.0
    return counts["rows"]


def grow(table: DataFrame, settings: Sequence[Settings], features: int, bins: int) -> list[Model]:
    """Grow one model per entry of ``settings`` on ``table``, which is scanned again and again and should be stored.

    ``table`` has ``row_id``, ``bins`` (array of ``features`` numbers, 0 for missing, all below ``bins``) and
    the bit sets ``trains``, ``held`` and ``label`` over the models. A model with ``patience`` keeps
    the trees up to its lowest loss on the rows it holds.
    """
    if len(settings) > MAX_MODELS:
        raise ValueError(f"at most {MAX_MODELS} models grow together")
    models = [Model(k, s, features) for k, s in enumerate(settings)]
    count = _started(models, table)
    rows = table.select("row_id", "bins", "trains", "held", "label")
    # Blocks are dealt out, because a table that few tasks wrote would be scanned by few. All tasks get several.
    tasks = max(1, table.sparkSession.sparkContext.defaultParallelism)
    most = max(1, min(BLOCK, -(-count // (BLOCKS_PER_TASK * tasks))))
    flat = ", ".join(f"{c} binary" for c in BLOCK_COLUMNS)
    blocks = rows.mapInArrow(_packed(features, bins, [m.base for m in models], most), flat)
    stored, path = written_at(blocks.repartition(tasks * max(1, -(-rows.rdd.getNumPartitions() // tasks))))
    with _few_blocks(table.sparkSession):
        _grow_all(models, *_few_tasks(stored), path, features, bins)
    for m in models:
        if m.losses:
            m.trees = m.trees[: m.best + 1]
    return models


def _few_tasks(stored: DataFrame) -> tuple[DataFrame, int]:
    """The blocks, read by no more tasks than run at a time, and the number of them: fewer tables of sums per pass."""
    tasks, most = stored.rdd.getNumPartitions(), max(1, stored.sparkSession.sparkContext.defaultParallelism)
    return (stored, tasks) if tasks <= most else (stored.coalesce(most), most)


def _learned(model: Model, parts: list[tuple[int, ...]], found: dict[tuple[int, int, int], np.ndarray], features: int, bins: int) -> None:
    """Give the sums of a pass to the open nodes, and those that follow from sums of pairs to the sides of their splits."""
    sides = []
    for node in model.open:
        tables = {part: found[model.number, i, node].reshape(3, *[bins] * len(part)) for i, part in enumerate(parts) if (model.number, i, node) in found}
        model.learn(node, _by_feature(tables, features, bins))
        if model.splits[node] and len(parts[0]) == 2:
            sides += [(node, side, tables) for side in (model.tree.left[node], model.tree.right[node]) if side not in model.splits]
    for node, side, tables in sides:
        f = model.tree.feature[node]
        goes = _goes_left(model.tree, node, bins) == (side == model.tree.left[node])
        kept = {part: np.compress(goes, t, 1 + part.index(f)) for part, t in tables.items() if f in part}
        sums = np.zeros((features, bins, 3))
        for part, t in kept.items():
            other = part[1 - part.index(f)]
            sums[other] = t.sum(1 + part.index(f)).T
            sums[f, goes] = t.sum(2 - part.index(f)).T
        model.learn(side, sums)


def _by_feature(tables: dict[tuple[int, ...], np.ndarray], features: int, bins: int) -> np.ndarray:
    """(features, bins, 3) from the sums of features or of pairs."""
    sums = np.zeros((features, bins, 3))
    for part, t in tables.items():
        for i, f in enumerate(part):
            sums[f] = (t if len(part) == 1 else t.sum(2 - i)).T
    return sums


def _grow_all(models: list[Model], stored: DataFrame, tasks: int, path: str, features: int, bins: int) -> None:
    """Passes over the stored blocks until every model is done; the blocks are removed then."""
    spark = stored.sparkSession
    while active := [m for m in models if not m.done]:
        if max(len(m.trees) - m.stored for m in active) >= STORE_ROUNDS:
            new = {m.number: m.trees[m.stored :] for m in active}
            renewed, renewed_path = written_at(stored.mapInArrow(_with_scores(new, features, bins, len(models)), stored.schema))
            removed(spark, path)
            path = renewed_path
            stored, tasks = _few_tasks(renewed)
            for m in active:
                m.stored = len(m.trees)
        for m in active:
            if m.tree is None:
                m.begin_tree()
        parts = _parts(active, bins)
        plans = [_plan(m, p) for m, p in zip(active, parts)]
        found = _added(stored.mapInArrow(_sums(plans, features, bins, len(models)), _SUMS), tasks)
        for m, p in zip(active, parts):
            if (loss := found.get((m.number, -1, -1))) is not None:
                m.lost(loss[0] / UNIT / loss[1])
            _learned(m, p, found, features, bins)
            if m.open:
                m.advance()
            elif m.tree is None:
                m.done = True  # that was the loss after the last round
            if m.tree is None and len(m.trees) >= m.settings.rounds and m.settings.patience is None:
                m.done = True
    removed(spark, path)
