"""Intermediate tables in shared storage, and joins with a size check.

Multi-pass operators cut their lineage here. Everything goes to the folder that
``spark.checkpoint.dir`` names, so a lost executor only costs a re-read.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only after this many rows were counted as its upper bound.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only on a local master."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="creditspark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small or row-shaped intermediate result."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write a large intermediate result as parquet and read it back.

    Later passes then prune columns and push filters into the scan.
    """
    return written_at(df)[0]


def written_at(df: DataFrame) -> tuple[DataFrame, str]:
    """As ``written``, with the path for ``removed``."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._is_stored = True
    return table, path


def stored(df: DataFrame) -> DataFrame:
    """``df`` if it comes from ``written`` as it is, else written: for operators that read their input several times."""
    return df if getattr(df, "_is_stored", False) else written(df)


def as_stored(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df``, which leaves out some rows or columns of ``source``, marked as read from a table if that one is."""
    df._reads_stored = getattr(source, "_is_stored", False) or getattr(source, "_reads_stored", False)
    return df


def reads_stored(df: DataFrame) -> bool:
    """True if reading ``df`` again costs a scan of a stored table and nothing that was joined before."""
    return getattr(df, "_is_stored", False) or getattr(df, "_reads_stored", False)


def removed(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete every intermediate table of this session's checkpoint folder."""
    folder = spark.sparkContext.getCheckpointDir()
    if folder is not None:
        removed(spark, folder)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, width: int | None = None) -> bool:
    """True if the counted rows, and their average width in bytes where given, fit a broadcast."""
    found = df.count()
    return found <= rows and (width is None or found * width <= BROADCAST_BYTES)


def row_width(df: DataFrame) -> int:
    """Bytes of an average row by its texts and arrays; 8 for any other column."""
    wide = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType))]
    fixed = 8 * (len(df.columns) - len(wide))
    if not wide:
        return fixed
    text = F.to_json(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in wide]))
    return fixed + int(df.agg(F.avg(F.length(text))).first()[0] or 0)


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join that broadcasts ``small`` when its rows and their measured width were found to fit, else
    lets Spark shuffle both sides (adaptive execution splits skewed keys there)."""
    return big.join(F.broadcast(small) if is_small(small, rows, row_width(small)) else small, on, how)


def join_with_nulls(big: DataFrame, small: DataFrame, keys: Sequence[str], checked: bool = False) -> DataFrame:
    """Inner join in which a null key meets a null key; ``big``'s key columns stay."""
    renamed = small.withColumnsRenamed({k: f"_key_{i}" for i, k in enumerate(keys)})
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    on = reduce(Column.__and__, same)
    joined = join_checked(big, renamed, on) if checked else big.join(renamed, on)
    return joined.drop(*[f"_key_{i}" for i in range(len(keys))])
