"""Language by a string kernel: n-gram presence, Nystroem landmarks and kernel ridge regression.

The kernel of two texts is the number of letter n-grams (1 to 3 bytes) present in both, over
the root of the product of their numbers (blended spectrum, presence). Landmark texts
give the Nystroem features ``K(x, landmarks) K(landmarks, landmarks)^-1/2``, on
which one ridge regression per language is fitted. Its scores are linear in the presence
vector, so a batch of texts is scored by products of its presence matrix with a
precomposed matrix, over all n-grams that any landmark has, some thousand at a time.

Learning uses about ``SAMPLE`` labelled texts per language and about ``LANDMARKS`` of them as landmarks (fewer
each if there are more than ``MOST_LANDMARKS`` in all): those with the smallest hashes of their text, found by a limit that follows from
the number of different texts of the language. Products of features are summed up where the texts are; what reaches the driver
depends on the landmarks and languages only. Every whole text is scored, from its bytes alone.

Null texts and texts without a letter are ``und`` with score 0; so is everything if nothing
can be learned. Labels that are null are not learned. Repeated texts of a language are learned once, repeated rows are scored alike; of equal scores the
first language in alphabetical order is taken. Texts of any length are read whole, in blocks. Further columns are not read, whatever their
names. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textcodes as tc
from .tables import Scratch

LANDMARKS = 64
MOST_LANDMARKS = 1024
SAMPLE = 1500
RIDGE = 1e-3
UNKNOWN = "und"
BLOCK_BYTES = 1 << 20
# N-grams that the presence matrix has at a time.
GRAMS_AT_ONCE = 4096
PRESENCE_BYTES = 16 << 20
# Tasks that sum up products of the bounded sample.
LEARNERS = 8
_HASHES = 1 << 30

# Bytes as symbols: 0 for anything but a letter, 1 to 26 for A-Z in either case, then bytes beyond ASCII.
SYMBOLS = np.zeros(256, np.int32)
SYMBOLS[97:123] = SYMBOLS[65:91] = np.arange(1, 27)
SYMBOLS[128:] = np.arange(27, 155)
N_SYMBOLS = 155
LIMITS = (0, N_SYMBOLS, N_SYMBOLS + N_SYMBOLS**2, N_SYMBOLS + N_SYMBOLS**2 + N_SYMBOLS**3)


@dataclass
class KernelModel:
    languages: list[str]
    place: np.ndarray  # of each possible n-gram among the known ones; their number if it isn't
    weights: np.ndarray  # known n-grams and the bias x languages

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row per text, one column per language."""
        present = Presence(self.place, len(self.weights) - 1, data, offsets)
        return present.times(self.weights[:-1]) / present.norm[:, None] + self.weights[-1]


def grams(data: np.ndarray, offsets: np.ndarray):
    """(row, code) of every n-gram of each row, in blocks of bounded size."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(at + BLOCK_BYTES, end)
        reach = min(to + 2, end)
        symbol = SYMBOLS[data[at:reach]]
        row = (np.searchsorted(offsets, np.arange(at, reach), "right") - 1).astype(np.int32)
        n = to - at
        yield row[:n], symbol[:n]
        for size in (2, 3):
            last = min(n, reach - at - size + 1)
            if last <= 0:
                continue
            code = symbol[:last].astype(np.int32)
            for k in range(1, size):
                code = code * N_SYMBOLS + symbol[k : last + k]
            same = row[:last] == row[size - 1 : last + size - 1]
            yield row[:last][same], code[same] + LIMITS[size - 1]
        at = to


class Presence:
    """Which known n-grams each text has, as a 0/1 matrix, and the root of the number of all n-grams it has."""

    def __init__(self, place: np.ndarray, width: int, data: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        self.seen, others = np.zeros((n, width), bool), [np.zeros(0, np.int64)]
        for row, code in grams(data, offsets):
            at = place[code]
            known = at < width
            self.seen[row[known], at[known]] = True
            others.append(np.unique(row[~known].astype(np.int64) * LIMITS[-1] + code[~known]))
        more = np.bincount(np.unique(np.concatenate(others)) // LIMITS[-1], minlength=n)
        self.norm = np.sqrt(np.maximum(self.seen.sum(1) + more, 1))

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """The presence matrix times ``matrix`` (known n-grams x anything)."""
        out = np.zeros((len(self.seen), matrix.shape[1]))
        for at in range(0, len(matrix), GRAMS_AT_ONCE):
            out += self.seen[:, at : at + GRAMS_AT_ONCE].astype(np.float32) @ matrix[at : at + GRAMS_AT_ONCE]
        return out


def groups(offsets: np.ndarray, width: int):
    """Row ranges whose bytes and presence matrices are bounded."""
    most = max(1, PRESENCE_BYTES // (width + 1))
    for i, j in tc.row_blocks(offsets):
        for k in range(i, j, most):
            yield k, min(k + most, j)


def _gram_sets(batches):
    for batch in batches:
        data, offsets = tc.text_bytes(batch.column("text"))
        sets = []
        for i in range(len(batch)):
            parts = [np.unique(code) for _, code in grams(data, offsets[i : i + 2])]
            sets.append(np.unique(np.concatenate(parts)).astype(np.int32) if parts else np.zeros(0, np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("h"), pa.array(sets, pa.list_(pa.int32()))], ["lang", "h", "grams"]
        )


def _products(place: np.ndarray, matrix: np.ndarray, languages: list[str], weight: np.ndarray):
    """Sums of z z' and z y' over the texts of a task; ``matrix`` leads from presence to features."""
    number = {name: k for k, name in enumerate(languages)}

    def run(batches):
        width = matrix.shape[1] + 1
        squares, targets = np.zeros((width, width)), np.zeros((width, len(languages)))
        for batch in batches:
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            data, offsets = tc.text_bytes(batch.column("text"))
            for i, j in groups(offsets, len(matrix)):
                present = Presence(place, len(matrix), data, offsets[i : j + 1])
                z = np.hstack([present.times(matrix) / present.norm[:, None], np.ones((j - i, 1))])
                own = weight[lang[i:j]]
                squares += z.T @ (z * own[:, None])
                y = np.zeros((j - i, len(languages)))
                y[np.arange(j - i), lang[i:j]] = own
                targets += z.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([squares.ravel()]), pa.array([targets.ravel()])], ["squares", "targets"])

    return run


def train(labelled: DataFrame, scratch: Scratch | None = None) -> KernelModel:
    """Learn from ``lang, text``."""
    scratch = scratch or Scratch(labelled.sparkSession)
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").where(has_letter(F.col("text"))).select(
        "lang", "text", F.xxhash64("text").alias("h")
    )
    counts = rows.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    counts = scratch.write(counts, "counts")
    languages = sorted(r.lang for r in counts.select("lang").collect())  # the classes to tell apart
    if not languages:
        return KernelModel([], np.zeros(LIMITS[-1], np.int32), np.zeros((0, 0), np.float32))
    # The texts below a hash limit: about SAMPLE different ones of each language, at any size.
    share = lambda most: F.ceil(F.lit(float(_HASHES)) * most / F.col("n"))
    small = F.pmod("h", F.lit(_HASHES))
    texts = rows.join(F.broadcast(counts), "lang").where(small < share(SAMPLE)).groupBy("lang", "h").agg(
        F.min("text").alias("text"), F.first("n").alias("n")
    )
    texts = scratch.write(texts.coalesce(LEARNERS), "texts")
    each = max(1, min(LANDMARKS, MOST_LANDMARKS // len(languages)))
    sets = texts.where(small < share(each)).mapInArrow(_gram_sets, "lang string, h long, grams array<int>").orderBy("lang", "h").collect()
    if not sets:
        return KernelModel([], np.zeros(LIMITS[-1], np.int32), np.zeros((0, 0), np.float32))
    known = np.unique(np.concatenate([np.asarray(r["grams"], np.int64) for r in sets]))
    place = np.full(LIMITS[-1], len(known), np.int32)
    place[known] = np.arange(len(known))
    landmarks = np.zeros((len(known), len(sets)), np.float32)
    for i, r in enumerate(sets):
        landmarks[place[np.asarray(r["grams"], np.int64)], i] = 1
    scaled = landmarks / np.sqrt(np.maximum(landmarks.sum(0), 1))
    value, vector = np.linalg.eigh(scaled.T.astype(np.float64) @ scaled)
    matrix = scaled.astype(np.float64) @ (vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-6))) @ vector.T)

    # Languages weigh alike, however many texts each has.
    taken = {r.lang: r["count"] for r in texts.groupBy("lang").count().collect()}
    weight = np.array([1 / taken[x] if x in taken else 0.0 for x in languages])
    got = texts.select("lang", "text").mapInArrow(_products(place, matrix, languages, weight), "squares array<double>, targets array<double>").toArrow()
    total = [sum(np.asarray(x.values) for x in got.column(c)) for c in ("squares", "targets")]
    width = matrix.shape[1] + 1
    squares, targets = total[0].reshape(width, width), total[1].reshape(width, -1)
    fitted = np.linalg.solve(squares + RIDGE * np.eye(width), targets)
    # score(x) = presence(x) . weights / |x|^1/2 + bias, the bias kept in a last row.
    return KernelModel(languages, place, np.vstack([matrix @ fitted[:-1], fitted[-1:]]).astype(np.float32))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _predict(model: KernelModel):
    def run(batches):
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            data, offsets = tc.text_bytes(batch.column("text"))
            known = batch.column("known").to_numpy(zero_copy_only=False)
            best, score = np.full(len(batch), len(model.languages)), np.zeros(len(batch))
            if model.languages:
                for i, j in groups(offsets, len(model.weights)):
                    out = model.scores(data, offsets[i : j + 1])
                    best[i:j] = out.argmax(1)
                    score[i:j] = np.clip(out.max(1), 0, 1)
            best[~known], score[~known] = len(model.languages), 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the ids whose checksum leaves 2; null ids are learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def languages(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Per row ``doc_id``, ``held_out``, ``lang_pred`` and ``score``, learned from the rows not held out."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"), scratch)
    kind = docs.schema["doc_id"].dataType.simpleString()
    asked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), has_letter(F.col("text")).alias("known"), "text")
    return asked.mapInArrow(_predict(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
