"""Scorecard: WOE bins, logistic regression and points."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..plans.longform import TARGET, named
from ..plans.storage import written
from .metrics import ranking_metrics
from .woe import WoeBins, fit_woe, woe_transform


def score_points(
    p: Column,
    pdo: float = config.SCORE_PDO,
    base: float = config.SCORE_BASE,
    base_odds: float = config.SCORE_BASE_ODDS,
    direction: str = "risk",
) -> Column:
    """Integer score of a bad probability. ``direction="risk"``: a higher score means
    more risk (the default); ``"quality"``: a higher score means less risk."""
    if direction not in ("risk", "quality"):
        raise ValueError("direction must be 'risk' or 'quality'")
    factor = pdo / math.log(2)
    offset = base - factor * math.log(base_odds)
    odds = p / (1 - p + 1e-6)
    sign = 1 if direction == "risk" else -1
    return (F.lit(offset) + F.lit(sign * factor) * F.ln(odds + 1e-6)).cast("int")


@dataclass
class Scorecard:
    woe: WoeBins
    weights: list[float]  # of the features, in their order
    intercept: float
    pdo: float = config.SCORE_PDO
    base: float = config.SCORE_BASE
    base_odds: float = config.SCORE_BASE_ODDS

    @property
    def features(self) -> list[str]:
        return self.woe.features

    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.features, self.weights))

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``p``, the probability of bad."""
        terms = [F.lit(w) * named(f"{f}_woe") for f, w in self.coefficients().items()]
        total = reduce(Column.__add__, terms, F.lit(self.intercept))
        return woe_transform(df, self.woe).select(*map(named, df.columns), (1 / (1 + F.exp(-total))).alias("p"))

    def gradient(self, df: DataFrame, target: str = TARGET, c: float = config.LR_C) -> DataFrame:
        """(feature, gradient) of the penalised loss that the fit minimises, null for the intercept; all are zero at the best weights."""
        scored = woe_transform(self.predict(df.where(named(target).isNotNull())), self.woe)
        miss = F.col("p") - named(target)
        row = scored.agg(*[F.sum(miss * named(f"{f}_woe")).alias(f"g{i}") for i, f in enumerate(self.features)], F.sum(miss).alias("g"))
        each = [F.struct(F.lit(f).alias("feature"), (F.col(f"g{i}") + w / c).alias("gradient")) for i, (f, w) in enumerate(self.coefficients().items())]
        return row.select(F.inline(F.array(*each, F.struct(F.lit(None).cast("string").alias("feature"), F.col("g").alias("gradient")))))

    def score(self, df: DataFrame, direction: str = "risk") -> DataFrame:
        """Add ``p`` and the integer ``score``."""
        points = score_points(F.col("p"), self.pdo, self.base, self.base_odds, direction)
        return self.predict(df).withColumn("score", points)

    def score_map(self) -> DataFrame:
        """Bins with the coefficient and the points each bin adds to the score."""
        factor = self.pdo / math.log(2)
        pairs = [x for f, c in self.coefficients().items() for x in (F.lit(f), F.lit(float(c)))]
        return self.woe.bins.withColumn("coefficient", F.create_map(*pairs)[F.col("feature")]).withColumn(
            "points", F.lit(factor) * F.col("coefficient") * F.col("woe")
        )

    def score_range(self, df: DataFrame) -> DataFrame:
        return self.score(df).agg(F.min("score").alias("min_score"), F.max("score").alias("max_score")).select(
            "*", F.lit(self.pdo).alias("pdo"), F.lit(self.base).alias("base_score"),
            F.lit(self.base_odds).alias("base_odds"), F.lit(len(self.features)).alias("n_features"),
        )

    def save(self, folder: str) -> None:
        self.woe.save(f"{folder}/woe")
        spark = self.woe.bins.sparkSession
        spark.createDataFrame(
            [([float(w) for w in self.weights], float(self.intercept), float(self.pdo), float(self.base), float(self.base_odds))],
            "weights array<double>, intercept double, pdo double, base double, base_odds double",
        ).write.mode("overwrite").parquet(f"{folder}/settings")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Scorecard:
        kept = spark.read.parquet(f"{folder}/settings").first()
        return cls(WoeBins.load(spark, f"{folder}/woe"), list(kept.weights), kept.intercept, kept.pdo, kept.base, kept.base_odds)


def _newton_sums(width: int, weights: np.ndarray):
    """Loss, gradient and upper curvature of the patterns of a task, as (place, value) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + width + width * width)
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width - 1)] + [np.ones(len(batch))], 1)
            n, bad = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (width - 1, width))
            z = x @ weights
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            total[0] += (n * np.logaddexp(0, z) - bad * z).sum()
            total[1 : 1 + width] += x.T @ (n * p - bad)
            total[1 + width :] += (x.T @ (x * (n * p * (1 - p))[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["place", "value"])

    return run


def newton_weights(patterns: DataFrame, columns: Sequence[str], c: float, max_iter: int, tolerance: float = 1e-9) -> np.ndarray:
    """Weights of ``columns`` and the intercept that minimise the summed log loss plus ``|w|^2 / 2c``.

    ``patterns`` has ``n`` rows and ``bad`` of them per distinct row of the columns. Each Newton step is one
    pass over it that brings (columns + 1)^2 sums to the driver; a step that raises the loss is halved.
    """
    width = len(columns) + 1
    table = patterns.select(*[named(x).cast("double") for x in columns], F.col("n").cast("double"), F.col("bad").cast("double"))
    ridge = np.append(np.full(width - 1, 1 / c), 0.0)

    def at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        found = table.mapInArrow(_newton_sums(width, weights), "place long, value double").groupBy("place").agg(F.sum("value")).toArrow()
        sums = np.zeros(1 + width + width * width)
        sums[found.column(0).to_numpy()] = found.column(1).to_numpy()
        loss = sums[0] + (ridge * weights * weights).sum() / 2
        return loss, sums[1 : 1 + width] + ridge * weights, sums[1 + width :].reshape(width, width) + np.diag(ridge)

    weights = np.zeros(width)
    loss, gradient, curve = at(weights)
    for _ in range(max_iter):
        if np.abs(gradient).max() <= tolerance:
            break
        step, share = np.linalg.lstsq(curve, gradient, rcond=None)[0], 1.0
        while True:
            tried = weights - share * step
            new = at(tried)
            if new[0] <= loss + 1e-9 * abs(loss) or share < 1e-6:
                break
            share /= 2
        done = np.abs(tried - weights).max() <= 1e-13 * max(1.0, np.abs(tried).max())
        weights, (loss, gradient, curve) = tried, new
        if done:
            break
    return weights


def train_scorecard(
    df: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    c: float = config.LR_C,
    max_iter: int = config.LR_MAX_ITER,
    pdo: float = config.SCORE_PDO,
    base: float = config.SCORE_BASE,
    base_odds: float = config.SCORE_BASE_ODDS,
) -> Scorecard:
    """Fit bins and an L2 logistic regression on the WOE columns.

    ``c`` is the inverse penalty of the summed loss; the intercept is not penalised. Rows collapse to their distinct
    WOE patterns with counts before the fit, so its passes read a table that hardly grows with the rows.
    """
    woe = fit_woe(df, features, target)
    columns = [f"{f}_woe" for f in features]
    coded = woe_transform(df.filter(named(target).isNotNull()), woe)
    patterns = coded.groupBy(*map(named, columns)).agg(F.count(F.lit(1)).alias("n"), F.sum(named(target)).alias("bad"))
    weights = newton_weights(written(patterns), columns, c, max_iter)
    return Scorecard(woe, [float(w) for w in weights[:-1]], float(weights[-1]), pdo, base, base_odds)


def scorecard_metrics(card: Scorecard, train: DataFrame, test: DataFrame, target: str = TARGET) -> DataFrame:
    """(sample, rows, bad_rate, auc, ks) of a scorecard on its training rows and on others."""
    both = card.predict(train).select(F.lit("train").alias("sample"), named(target), "p").unionByName(
        card.predict(test).select(F.lit("test").alias("sample"), named(target), "p")
    )
    return ranking_metrics(written(both), "p", target, ["sample"]).select("sample", "rows", "bad_rate", "auc", "ks")
