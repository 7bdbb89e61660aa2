"""Time-ordered split and cross-validation folds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..plans.longform import DATE, TARGET
from ..plans.ordered import contiguous_blocks
from ..plans.storage import stored

SPLITS = ("train", "val", "test")


def _minor(df: DataFrame, tiebreak: Sequence[str] | None) -> list[str]:
    return list(tiebreak) if tiebreak else [c for c in df.columns if c != DATE]


def _positions(cuts: Sequence[int]):
    return F.array(*[F.lit(int(c)).cast("long") for c in cuts])


def split_sizes(
    rows: int, test_size: float = config.TEST_SIZE, val_size: float = config.VAL_SIZE, val_of_rest: bool = True
) -> tuple[int, int, int]:
    """(train, val, test) row counts. ``val_size`` is a share of the rows left after
    the test rows, or of all rows with ``val_of_rest=False``."""
    if not val_of_rest:
        val_size = val_size / (1 - test_size)
    test = int(rows * test_size)
    val = int((rows - test) * val_size)
    return rows - test - val, val, test


def time_split(
    df: DataFrame,
    test_size: float = config.TEST_SIZE,
    val_size: float = config.VAL_SIZE,
    tiebreak: Sequence[str] | None = None,
    val_of_rest: bool = True,
) -> DataFrame:
    """Add ``split``: oldest rows train, then val, newest test.

    Rows of one date are ordered by ``tiebreak`` (default: all other columns).
    """
    df = stored(df)
    train, val, _ = split_sizes(df.count(), test_size, val_size, val_of_rest)
    placed = contiguous_blocks(df, [], DATE, _minor(df, tiebreak), _positions([train, train + val]))
    names = F.array(*[F.lit(s) for s in SPLITS])
    return placed.withColumn("split", F.get(names, F.col("block"))).drop("block")


def split_frames(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three parts of a table with a ``split`` column."""
    return tuple(df.filter(F.col("split") == s).drop("split") for s in SPLITS)


def split_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("rows"), F.avg(TARGET).alias("bad_rate"))


def stratified_folds(
    df: DataFrame, folds: int = config.CV_FOLDS, tiebreak: Sequence[str] | None = None, target: str = TARGET
) -> DataFrame:
    """Add ``fold`` (1-based): every class is cut into contiguous time-ordered blocks.

    Classes are laid end to end, the class of the first row first, and dealt to the
    folds in turn; that decides which folds get one row more.
    """
    df, minor = stored(df), _minor(df, tiebreak)
    classes = df.groupBy(target).agg(F.count("*").alias("n"), F.min(DATE).alias("day")).orderBy("day").collect()
    if len({row.day for row in classes}) < len(classes):
        # Classes that begin on one day: its first row decides, and only that day is looked at.
        begins = [F.col(target).eqNullSafe(row[target]) & F.col(DATE).eqNullSafe(row.day) for row in classes]
        first = df.filter(reduce(Column.__or__, begins)).groupBy(target, DATE).agg(F.min(F.struct(*minor)).alias("first"))
        place = {row[target]: i for i, row in enumerate(first.orderBy(DATE, "first").collect())}
        classes.sort(key=lambda row: place[row[target]])
    cuts, start = F.lit(None).cast("array<bigint>"), 0
    for row in classes:
        # Fold i owns the places i, i + folds, ... of the dealt sequence.
        ends, total = [], 0
        for i in range(folds - 1):
            total += len(range(start + (i - start) % folds, start + row.n, folds))
            ends.append(total)
        cuts = F.when(F.col(target).eqNullSafe(row[target]), _positions(ends)).otherwise(cuts)
        start += row.n
    placed = contiguous_blocks(df, [target], DATE, minor, cuts)
    return placed.withColumn("fold", F.col("block") + 1).drop("block")


def forward_folds(
    df: DataFrame, folds: int = config.CV_FOLDS, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Add ``fold``: fold k validates on its block and trains on all earlier blocks.

    Block 0 is never validated; it also takes the rows left over by equal blocks.
    """
    df = stored(df)
    rows = df.count()
    size = rows // (folds + 1)
    cuts = [rows - size * (folds - i) for i in range(folds)]
    return contiguous_blocks(df, [], DATE, _minor(df, tiebreak), _positions(cuts), name="fold")
