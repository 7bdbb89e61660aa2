"""Toxicity as severity grades, by cumulative-link ordinal regression on sparse text features.

Grades are ordered: 0 clean, 1 toxic, 2 toxic with more telling
features than most toxic texts have. The model has
one weight vector for all thresholds, ``P(grade <= k) = sigmoid(t_k - w x)``, and a text's
expected severity is the sum of ``P(grade > k)``. Features are words and word beginnings of
4 to 8 bytes; only those that are significantly more frequent
in toxic than in clean documents are kept, so a long clean text stays clean.

The model is fitted on at most about ``SAMPLE`` labelled documents (drawn by a hash of the
id); scores cover every whole text. Feature counts, selection and scoring run on executors,
the fit itself on the bounded sample's few selected features.

Null and empty texts have no features and are not rejected. Labels that are null, or of
documents that are not there, are left out; texts that occur more than once count once, as toxic if one label says so. Without
any toxic label nothing is rejected. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcodes as tc
from .tables import Scratch, returning

SAMPLE = 12_000
BEGINNINGS = (4, 5, 6, 7, 8)
LEAST_TOXIC = 4
Z_SCORE = 3.5
REJECT = 0.5
GRADES = 3


@dataclass
class OrdinalModel:
    codes: np.ndarray  # sorted uint64
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k, one row per score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -30, 30)))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of all words and word beginnings."""
    _, _, row, code, heads = tc.words(data, offsets, tc.ALNUM, BEGINNINGS)
    return np.concatenate([row, *(row[own] for own, _ in heads)]), np.concatenate([code, *(c for _, c in heads)])


def _document_counts(batches):
    """(code, toxic documents, documents) of each batch."""
    for batch in batches:
        data, offsets = tc.text_bytes(batch.column("text"))
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for i, j in tc.row_blocks(offsets):
            row, code = features(data, offsets[i : j + 1])
            order = np.lexsort((row, code))
            row, code = row[order], code[order]
            new = np.ones(len(code), bool)
            new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
            row, code = row[new], code[new]
            starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, int)
            if not len(starts):
                continue
            bad = np.add.reduceat(toxic[i + row].astype(np.int64), starts)
            every = np.diff(np.append(starts, len(code)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(code[starts].view(np.int64)), pa.array(bad), pa.array(every.astype(np.int64))], ["code", "bad", "every"]
            )


def _selected_counts(codes: np.ndarray):
    """Per row: the places of its selected features, and their counts."""

    def run(batches):
        for batch in batches:
            data, offsets = tc.text_bytes(batch.column("text"))
            at, n = [], []
            for i, j in tc.row_blocks(offsets):
                row, place, count, _ = chosen_counts(codes, data, offsets[i : j + 1])
                limits = np.searchsorted(row, np.arange(j - i + 1))
                at += [place[a:b].astype(np.int32) for a, b in zip(limits[:-1], limits[1:])]
                n += [count[a:b].astype(np.int32) for a, b in zip(limits[:-1], limits[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(at, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32()))],
                ["toxic", "at", "n"],
            )

    return run


def chosen_counts(codes: np.ndarray, data: np.ndarray, offsets: np.ndarray):
    """(row, place among ``codes``, count) of the selected features of each row, by row; and the rows."""
    row, code = features(data, offsets)
    place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    hit = codes[place] == code
    key = row[hit] * len(codes) + place[hit]
    key, count = np.unique(key, return_counts=True)
    return key // len(codes), key % len(codes), count, len(offsets) - 1


def weigh(count: np.ndarray) -> np.ndarray:
    """A feature counts once, and a little more with every doubling."""
    return 1 + 0.2 * np.log2(np.maximum(count, 1))


def fit_ordinal(rows, cols, values, grade, n_features, steps: int = 800, penalty: float = 5e-6):
    """Weights and ascending thresholds that maximise the penalised likelihood (Adam, full batch).

    All features were selected as signs of toxicity, so no weight may fall below zero."""
    n, top = len(grade), GRADES - 1
    w, base, gaps = np.zeros(n_features), 1.0, np.zeros(top - 1)
    params = np.concatenate([w, [base], gaps])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, base, gaps = params[:n_features], params[n_features], params[n_features + 1 :]
        thresholds = base + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        score = np.bincount(rows, weights=w[cols] * values, minlength=n)
        below = np.concatenate([np.zeros((n, 1)), 1 / (1 + np.exp(np.clip(score[:, None] - thresholds, -30, 30))), np.ones((n, 1))], 1)
        slope = below * (1 - below)
        at = np.arange(n)
        chance = np.maximum(below[at, grade + 1] - below[at, grade], 1e-12)
        d_score = (slope[at, grade + 1] - slope[at, grade]) / chance / n  # of the negative log-likelihood
        d_threshold = np.array([
            -(slope[:, k + 1] * ((grade == k).astype(float) - (grade == k + 1)) / chance).sum() / n for k in range(top)
        ])
        grad = np.concatenate([
            np.bincount(cols, weights=d_score[rows] * values, minlength=n_features) + penalty * w,
            [d_threshold.sum()],
            [d_threshold[k + 1 :].sum() * np.exp(gaps[k]) for k in range(top - 1)],
        ])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        params = params - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        params[:n_features] = np.maximum(params[:n_features], 0)
    w, base, gaps = params[:n_features], params[n_features], params[n_features + 1 :]
    return w, base + np.concatenate([[0], np.cumsum(np.exp(gaps))])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, scratch: Scratch | None = None) -> OrdinalModel:
    scratch = scratch or Scratch(docs.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n = known.count()
    if n > sample:
        # The first rows by a hash, so about ``sample`` of them at any size.
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * sample / n))
    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(known), "doc_id").groupBy("text").agg(
        F.max("toxic").alias("toxic")
    )
    texts = scratch.write(texts, "sample")
    none = OrdinalModel(np.zeros(0, np.uint64), np.zeros(0), np.array([30.0, 31.0]))
    bad, every = texts.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    if not bad or bad == every:
        return none
    counts = texts.mapInArrow(returning(_document_counts), "code long, bad long, every long")
    counts = counts.groupBy("code").agg(F.sum("bad").alias("bad"), F.sum("every").alias("every")).where(F.col("bad") >= LEAST_TOXIC)
    # Significance of the difference between the shares of toxic and of clean documents.
    clean = F.col("every") - F.col("bad")
    share = F.col("every") / every
    z = (F.col("bad") / bad - clean / (every - bad)) / F.sqrt(share * (1 - share) * (1 / bad + 1 / (every - bad)) + 1e-12)
    best = counts.select("code", z.alias("z"), (F.col("bad") / F.col("every")).alias("purity")).where((F.col("z") >= Z_SCORE) & (F.col("purity") >= 0.5))
    best = best.select("code").toArrow()  # of the bounded sample
    if not best.num_rows:
        return none
    codes = np.sort(best.column("code").to_numpy().view(np.uint64))
    got = texts.mapInArrow(returning(_selected_counts(codes)), "toxic int, at array<int>, n array<int>").toArrow()
    toxic = got.column("toxic").to_numpy()
    at, n = got.column("at").combine_chunks(), got.column("n").combine_chunks()
    lengths = np.diff(at.offsets.to_numpy())
    rows = np.repeat(np.arange(len(toxic)), lengths)
    cols, values = at.flatten().to_numpy(), weigh(n.flatten().to_numpy())
    evidence = np.bincount(rows, weights=values, minlength=len(toxic))
    telling = evidence[(toxic > 0) & (evidence > 0)]
    severe = np.median(telling) if len(telling) else np.inf
    grade = np.where(toxic > 0, np.where(evidence > severe, 2, 1), 0)
    return OrdinalModel(codes, *fit_ordinal(rows, cols, values, grade, len(codes)))


def chances(model: OrdinalModel, text: pa.Array) -> np.ndarray:
    """P(grade > k) for every text and k."""
    data, offsets = tc.text_bytes(text)
    score = np.zeros(len(text))
    if len(model.codes):
        for i, j in tc.row_blocks(offsets):
            row, place, count, n = chosen_counts(model.codes, data, offsets[i : j + 1])
            score[i:j] = np.bincount(row, weights=model.weights[place] * weigh(count), minlength=n)
    return model.above(score)


def _scores(model: OrdinalModel):
    def run(batches):
        for batch in batches:
            above = chances(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above[:, 0]), pa.array(above.sum(1))], ["doc_id", "p_toxic", "expected_severity"]
            )

    return run


def severity(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """Per row ``doc_id``, ``p_toxic``, ``expected_severity`` (0 to 2), ``grade`` (nearest) and ``rejected``."""
    model = train(docs, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(
        returning(_scores(model)), f"doc_id {kind}, p_toxic double, expected_severity double"
    )
    return scored.select(
        "doc_id", "p_toxic", "expected_severity", F.round("expected_severity").cast("int").alias("grade"),
        (F.col("p_toxic") >= reject).alias("rejected"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, reject: float = REJECT, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` without the rows whose chance of being toxic reaches ``reject``, with all their columns, whatever
    their names; one scan, no shuffle."""
    model = train(docs, labels, scratch=scratch)
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(chances(model, batch.column(at))[:, 0] < reject))

    return docs.mapInArrow(returning(keep), docs.schema)
