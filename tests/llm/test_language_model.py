"""The language model against a dense version, hot and repeated texts, and learning without unbounded work."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from creditspark.llm import language, textcodes as tc

SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["xu", "wy", "zo"], "cc": ["étr", "çon", "ñe"], "dd": ["по", "ка", "ми"]}


def some_text(lang, seed, n=15):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(n))


def gram_set(text):
    """All n-grams of 1 to 3 bytes whose last bytes are letters, as tuples of symbols."""
    symbols = language.SYMBOLS[np.frombuffer((text or "").encode(), np.uint8)].tolist()
    return {tuple(symbols[i : i + n]) for n in (1, 2, 3) for i in range(len(symbols) - n + 1)}


def test_scores_equal_a_dense_kernel_model(spark, monkeypatch):
    """Kernel, Nystroem features, weighted ridge regression and scores, without blocks or partial sums."""
    texts = [(lang, some_text(lang, i, 6 + i % 9)) for lang in SYLLABLES for i in range(12 + 5 * (lang == "aa"))]
    df = spark.createDataFrame(texts, "lang string, text string").repartition(3)
    monkeypatch.setattr(language, "GRAMS_AT_ONCE", 7)
    monkeypatch.setattr(language, "PRESENCE_BYTES", 300)
    model = language.train(df)
    asked = [some_text(lang, 1000 + i) for lang in SYLLABLES for i in range(4)] + ["", "x", "zzz qqq", texts[0][1]]
    data, offsets = tc.text_bytes(pa.array(asked))
    got = np.concatenate([model.scores(data, offsets[i : j + 1]) for i, j in language.groups(offsets, len(model.weights))])

    # All texts are few, so each is in the sample and a landmark.
    sets = [gram_set(t) for _, t in texts]
    kernel = lambda a, b: len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1))
    k = np.array([[kernel(a, b) for b in sets] for a in sets])
    value, vector = np.linalg.eigh(k)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-6))) @ vector.T
    y = np.array([[float(lang == x) for x in sorted(SYLLABLES)] for lang, _ in texts])
    weight = 1 / y.sum(0)[y.argmax(1)]
    z = np.hstack([k @ root, np.ones((len(k), 1))])
    fitted = np.linalg.solve(z.T @ (z * weight[:, None]) + language.RIDGE * np.eye(z.shape[1]), z.T @ (y * weight[:, None]))
    own = np.array([[kernel(gram_set(t), b) for b in sets] for t in asked])
    expected = np.hstack([own @ root, np.ones((len(own), 1))]) @ fitted
    assert model.languages == sorted(SYLLABLES)
    assert np.abs(got - expected).max() < 2e-4  # weights are kept in single precision


def test_hot_and_repeated_texts_are_learned_once(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 40)
    monkeypatch.setattr(language, "LANDMARKS", 10)
    texts = [("aa", some_text("aa", i)) for i in range(900)] + [("aa", "ka lo ka")] * 900 + [("bb", some_text("bb", i)) for i in range(30)]
    df = spark.createDataFrame(texts, "lang string, text string").repartition(4)
    seen = []
    write = language.Scratch.write
    monkeypatch.setattr(language.Scratch, "write", lambda self, d, name, by=None: (seen.append((name, write(self, d, name, by))), seen[-1][1])[1])
    model = language.train(df)
    sample = dict(seen)["texts"].groupBy("lang").count().collect()
    taken = {r.lang: r["count"] for r in sample}
    assert 20 <= taken["aa"] <= 65 and taken["bb"] == 30
    data, offsets = tc.text_bytes(pa.array([some_text("aa", 5000), some_text("bb", 5000)]))
    assert model.scores(data, offsets).argmax(1).tolist() == [0, 1]


def test_learning_has_no_window(spark):
    df = spark.createDataFrame([(i, "aa", some_text("aa", i)) for i in range(20)], "doc_id long, lang string, text string")
    plans = []
    write = language.Scratch.write

    def noted(self, d, name, by=None):
        plans.append(d._jdf.queryExecution().executedPlan().toString())
        return write(self, d, name, by)

    language.Scratch.write = noted
    try:
        language.train(df.select("lang", "text").where(F.col("doc_id") >= 0))
    finally:
        language.Scratch.write = write
    assert plans and not any("Window" in p for p in plans)
