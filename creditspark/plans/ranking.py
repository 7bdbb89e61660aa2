"""Places of rows in an order, found without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .longform import named
from .storage import join_with_nulls, written


def with_places(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "place") -> DataFrame:
    """Add the place from 0 of every row in its group by ``order``; equal rows follow each other in any order.

    Rows are sorted over range partitions and counted per partition and group; the counts
    before a partition, a table of about one row per partition, are added to the place inside it.
    """
    keys = [*map(named, group), *map(named, order)]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = written(ranged.withColumn("_seq", F.monotonically_increasing_id()))
    stored = stored.withColumn("_part", F.shiftright("_seq", 33))
    parts = stored.groupBy(*map(named, group), "_part").agg(F.min("_seq").alias("_low"), F.count(F.lit(1)).alias("_here"))
    before = Window.partitionBy(*map(named, group)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(*map(named, group), "_part", (F.coalesce(F.sum("_here").over(before), F.lit(0)) - F.col("_low")).alias("_shift"))
    joined = join_with_nulls(stored, written(shifts), [*group, "_part"], checked=True)
    return joined.withColumn(name, F.col("_seq") + F.col("_shift")).select(*map(named, df.columns), name)
