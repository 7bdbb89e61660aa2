"""Intermediate tables of one operator run, in the shared folder of the session.

A ``Scratch`` names a fresh folder below the session's checkpoint folder. Tables
written there cut the lineage and outlive any executor; each is deleted as soon
as no later step reads it.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.storage import checkpoint_folder

# Sides of joins are broadcast only below this many bytes by count of rows and row width.
BROADCAST_BYTES = 8 << 20
# Rows of a batch that a task hands to Python, in place of Spark's 10,000: texts may be long.
BATCH_ROWS = 2000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def session_settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the jobs started inside, those of before at the end."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class Scratch:
    """Written tables of one run, kept until dropped or until ``release``."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.names: set[str] = set()
        self.folder = f"{checkpoint_folder(spark)}/llm-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write ``df``, split into folders by column ``by`` where given, and read it back.

        The shuffle files of the write are released at its end, and tasks hand rows to Python in batches
        of ``BATCH_ROWS`` at most.
        """
        path = f"{self.folder}/{name}"
        self.names.add(name)
        rows = int(self.spark.conf.get(BATCH))
        with session_settings(self.spark, {CLEANUP: "true", BATCH: str(rows if 0 < rows < BATCH_ROWS else BATCH_ROWS)}):
            writer = df.write.mode("overwrite")
            (writer.partitionBy(by) if by else writer).parquet(path)
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.names.discard(name)

    def keep(self, *names: str) -> None:
        """Drop all tables but these."""
        self.drop(*self.names.difference(names))


def give_back() -> None:
    """Hand memory that this process has freed back to the system, where the C library can do so."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def returning(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow`` in a worker that gives back at the end of a task what it freed, as workers live on
    beside the next stages of their executor."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return work


def join_small(big: DataFrame, small: DataFrame, on, how: str, row_bytes: int) -> DataFrame:
    """Join that broadcasts ``small`` if its counted rows fit ``BROADCAST_BYTES`` at ``row_bytes``
    each; else Spark shuffles both sides and adaptive execution splits hot keys."""
    fits = small.count() * row_bytes <= BROADCAST_BYTES
    return big.join(F.broadcast(small) if fits else small, on, how)


# Name of the written row number, longer where ``docs`` have such a column; the mark in its metadata tells it.
ROW = "__llm_row"
_MARK = {"llm_row": True}


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, longer by underscores as long as ``docs`` have such a column (in any case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_name(docs: DataFrame) -> str | None:
    """Name of the row number of numbered ``docs``, None for others."""
    return next((f.name for f in docs.schema if f.metadata == _MARK), None)


def numbered(docs: DataFrame, scratch: Scratch, *columns: str) -> DataFrame:
    """``docs`` (only ``columns`` where given) with a row number in ``ROW``, written once.

    Numbers of two scans of one table can differ, as the splits of a scan follow the cores registered when
    its job is planned; all jobs that join by row read this table. Numbered ``docs`` come back as they are.
    """
    if row_name(docs):
        return docs
    chosen = docs.select(*columns) if columns else docs
    number = F.monotonically_increasing_id().alias(free_name(chosen, ROW), metadata=_MARK)
    return scratch.write(chosen.select("*", number), "numbered")


def row_of(docs: DataFrame) -> Column:
    """The written number of numbered ``docs``, else a fresh one: good for a single scan only."""
    name = row_name(docs)
    return F.col(name).alias("_row", metadata={}) if name else F.monotonically_increasing_id()


def back_to(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Join rows of numbered ``docs`` with ``found`` by its ``_row``; other columns of ``found`` need
    names that ``docs`` don't have."""
    number = row_name(docs)
    return docs.join(found.withColumnRenamed("_row", number), number, how)
