"""Files of token ids: canonical length-limited Huffman codes in independently decodable blocks.

``write_ids`` makes a folder of four tables:

- ``codes``: id and code length of every id that occurs, from counts over all documents;
- ``runs``: one row per run of whole documents in ascending ``doc_id`` order, with the encoded
  ids (layout in ``huffman``), the documents' ids and lengths;
- ``parts``: ids before each part of ``runs``;
- ``totals``: documents, ids and the end id.

One pass sorts the texts by range, tokenises them and writes their ids as runs of plain numbers, of
two bytes where the vocabulary allows; two light passes over those count the ids and encode the
runs, and the plain ones are dropped. A run is written by one task and read by one task, so a lost
executor costs the repetition of its tasks. The driver sees one count per id of the vocabulary and
one row per part.

Null and empty texts have the end id alone. Documents of one id follow each other in the
order of a hash of their texts, equal rows in any order; null ids come first. A very long
text is a run of its own, encoded in blocks. Other columns are not read, whatever their names.
An empty table gives empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .huffman import LONGEST, Codec, code_lengths
from .tables import BATCH, Scratch, session_settings
from .tokenids import unit_ids, widest_id, with_end

END_ID = 2
# Ids after which a run ends.
RUN_IDS = 1 << 18
# Bits beyond the least that can tell all ids apart; more of them cost a larger decoding table.
SPARE_BITS = 2

# Rows of a batch, as each is a run.
RUNS_AT_ONCE = 16

_NAMES = ["part", "run", "before", "n_ids", "doc_ids", "lengths", "data"]
_RUNS = "part long, run long, before long, n_ids long, doc_ids array<{kind}>, lengths array<long>, data binary"
_DOCUMENTS = "doc_id {kind}, start long, n_tokens long, ids binary"


def _tokenised(tokenizer: str, end_id: int, narrow: bool):
    """Runs of whole documents in the order of the rows, with their ids as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names, sizes, ids = [], [], []
        held = before = number = 0

        def flushed():
            nonlocal names, sizes, ids, held, before, number
            row = [
                pa.array([part], pa.int64()), pa.array([number], pa.int64()), pa.array([before], pa.int64()), pa.array([held], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, sum(map(len, names))], pa.int32()), pa.concat_arrays(names)),
                pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
                pa.array([np.concatenate(ids).astype("<u2" if narrow else "<u4").tobytes()], pa.binary()),
            ]
            before, number = before + held, number + 1
            names, sizes, ids, held = [], [], [], 0
            return pa.RecordBatch.from_arrays(row, _NAMES)

        for batch in batches:
            own = batch.column("doc_id")
            for i, j, found, counts in unit_ids(tokenizer).of_column(batch.column("text")):
                found, counts = with_end(found, counts, end_id)
                names.append(own.slice(i, j - i))
                sizes.append(counts)
                ids.append(found)
                held += len(found)
                if held >= RUN_IDS:
                    yield flushed()
        if held:
            yield flushed()

    return run


def _plain(data: pa.Scalar, narrow: bool) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), "<u2" if narrow else "<u4")


def _count(narrow: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(0, np.int64)
        for batch in batches:
            for data in batch.column("data"):
                got = np.bincount(_plain(data, narrow), minlength=len(found))
                got[: len(found)] += found
                found = got
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(found[used])], ["id", "n"])

    return run


def _encode(lengths: np.ndarray, narrow: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(lengths)
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1)
                coded = pa.array([codec.encode(_plain(row.column("data")[0], narrow))], pa.binary())
                yield pa.RecordBatch.from_arrays([*row.columns[:-1], coded], _NAMES)

    return run


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> None:
    """Write the ids of all documents, each ended by ``end_id``, to ``folder``."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    narrow = max(widest_id(tokenizer), end_id) < 1 << 16
    order = [F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = docs.select("doc_id", "text", order[1].alias("_hash"), order[2].alias("_tie"))
    keys = ["doc_id", "_hash", "_tie"]
    ranged = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    schema = _RUNS.format(kind=docs.schema["doc_id"].dataType.simpleString())
    plain = scratch.write(ranged.mapInArrow(_tokenised(tokenizer, end_id, narrow), schema), "plain")

    with session_settings(spark, {BATCH: str(RUNS_AT_ONCE)}):
        each = plain.select("data").mapInArrow(_count(narrow), "id int, n long")
        # One row per id of the vocabulary.
        counts = each.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
        id_, n = counts.column("id").to_numpy(), counts.column("n").to_numpy()
        every = np.zeros(int(id_.max(initial=0)) + 1, np.int64)
        every[id_] = n
        lengths = code_lengths(every, min(LONGEST, max(1, int(len(id_)).bit_length() + SPARE_BITS)))
        plain.mapInArrow(_encode(lengths, narrow), schema).write.parquet(f"{folder}/runs")
    scratch.drop("plain")
    spark.createDataFrame(pa.table({"id": id_, "bits": lengths[id_].astype(np.int32)})).coalesce(1).write.parquet(f"{folder}/codes")

    runs = _runs(spark, folder)
    parts = runs.groupBy("part").agg(F.sum("n_ids").alias("n"), F.sum(F.size("lengths")).alias("docs")).toArrow().sort_by("part")
    sizes = parts.column("n").to_numpy()
    start = pa.table({"part": parts.column("part"), "first": pa.array((np.cumsum(sizes) - sizes).astype(np.int64))})
    spark.createDataFrame(start).coalesce(1).write.parquet(f"{folder}/parts")
    totals = [(int(parts.column("docs").to_numpy().sum()), int(sizes.sum()), end_id)]
    spark.createDataFrame(totals, "documents long, ids long, end_id int").coalesce(1).write.parquet(f"{folder}/totals")


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/runs")


def _open(spark: SparkSession, folder: str) -> tuple[DataFrame, np.ndarray]:
    """Runs with the place of their first id, and the code lengths."""
    codes = spark.read.parquet(f"{folder}/codes").toArrow()
    lengths = np.zeros(int(codes.column("id").to_numpy().max(initial=0)) + 1, np.uint8)
    lengths[codes.column("id").to_numpy()] = codes.column("bits").to_numpy()
    # One row per part of the writing job.
    parts = F.broadcast(spark.read.parquet(f"{folder}/parts"))
    return _runs(spark, folder).join(parts, "part").withColumn("first", F.col("first") + F.col("before")), lengths


def _documents(lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(lengths)
        for batch in batches:
            for k in range(len(batch)):
                ids = codec.decode(batch.column("data")[k].as_buffer())
                own, sizes = batch.column("doc_ids")[k].values, batch.column("lengths")[k].values.to_numpy()
                end = np.cumsum(sizes)
                limits = pa.array(np.concatenate([[0], 4 * end]).astype(np.int32))
                data = pa.Array.from_buffers(pa.binary(), len(own), [None, limits.buffers()[1], pa.py_buffer(ids.astype("<u4").tobytes())])
                start = end - sizes + batch.column("first")[k].as_py()
                yield pa.RecordBatch.from_arrays([own, pa.array(start), pa.array(sizes), data], ["doc_id", "start", "n_tokens", "ids"])

    return run


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids`` (little-endian
    unsigned 32-bit numbers) of every document, decoded from ``folder``."""
    runs, lengths = _open(spark, folder)
    kind = runs.schema["doc_ids"].dataType.elementType.simpleString()
    return runs.select("first", "doc_ids", "lengths", "data").mapInArrow(_documents(lengths), _DOCUMENTS.format(kind=kind))


def _stretch(lengths: np.ndarray, begin: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(lengths)
        for batch in batches:
            for first, n, data in zip(*(batch.column(c) for c in ("first", "n_ids", "data"))):
                low, first = max(0, begin - first.as_py()), first.as_py()
                ids = codec.decode(data.as_buffer(), low, min(n.as_py(), end - first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first + low], pa.int64()), pa.array([ids.astype("<u4").tobytes()], pa.binary())], ["start", "ids"]
                )

    return run


def read_stretch(spark: SparkSession, folder: str, begin: int, end: int) -> DataFrame:
    """``(start, ids)`` pieces of the ids ``begin`` to ``end`` (exclusive) of the whole sequence. Only
    runs that hold them are read, and of those only the blocks."""
    runs, lengths = _open(spark, folder)
    held = runs.where((F.col("first") < end) & (F.col("first") + F.col("n_ids") > begin))
    return held.select("first", "n_ids", "data").mapInArrow(_stretch(lengths, begin, end), "start long, ids binary")
