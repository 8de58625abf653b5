"""Counterfactually regularised toxicity classifier.

A logistic model over the presence of words.  Beside the label loss, training penalises the squared
change of the score when the identity terms of a labelled sentence are swapped for others of their
group, so a neutral mention of a group is not held against a text.

The model is fitted on at most ``SAMPLE`` labelled documents of either label outside the held-out fold
(a documented bound; those with the smallest hash of their id) and ``FEATURES`` words, chosen by a
distributed count over those rows.  Scoring is one map over all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import held_out, read, staged

SAMPLE = 6000
FEATURES = 1500
#: A word is a feature if its share of toxic rows differs from its share of others by so many standard errors.
SIGNIFICANT = 4.0
THRESHOLD = 0.3
#: Groups of identity terms; a term is swapped within its group.
IDENTITY = [
    ["women", "men", "girls", "boys"],
    ["woman", "man", "girl", "boy"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["gay", "straight", "lesbian", "bisexual", "transgender"],
    ["black", "white", "asian", "latino", "arab"],
    ["immigrants", "refugees", "foreigners", "natives", "locals"],
    ["old", "young", "elderly", "disabled", "blind", "deaf"],
]
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")
SWAP = {w: g[(i + 1) % len(g)] for g in IDENTITY for i, w in enumerate(g)}


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def counterfactual(text: str | None) -> str | None:
    """The text with the identity terms of every sentence swapped, or None if it has none."""
    low = (text or "").lower()
    if not words(low) & SWAP.keys():
        return None
    return _SENTENCE.sub(lambda s: _WORD.sub(lambda w: SWAP.get(w[0], w[0]), s[0]), low)


def train(x: np.ndarray, y: np.ndarray, swapped: np.ndarray, of: np.ndarray, penalty: float = 4.0,
          l2: float = 1e-3, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient descent; classes weigh the same.

    swapped: features of the counterfactuals; of: the row of x that each was made from."""
    n, d = x.shape
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) if n else np.ones(0)
    delta = swapped - x[of] if len(of) else np.zeros((0, d), np.float32)
    w, b, v, vb = np.zeros(d), 0.0, np.zeros(d), 0.0
    step, prior = 1.0, float(np.log(0.1 / 0.9))
    # words share documents: the curvature is bounded by the mean number of features
    curve = 0.25 * max((weight * (x.sum(axis=1) + 1)).sum(), 1.0) + l2
    if len(of):
        curve += 2 * penalty * (delta ** 2).sum(axis=1).mean()
    step = 1.0 / curve
    for k in range(steps):
        mix = k / (k + 3)
        wy, by = w + mix * (w - v), b + mix * (b - vb)
        p = 1 / (1 + np.exp(-(x @ wy.astype(np.float32) + by)))
        g = (weight * (p - y)).astype(np.float32)
        grad = x.T @ g + l2 * wy
        if len(of):
            grad = grad + 2 * penalty * (delta.T @ (delta @ wy.astype(np.float32))) / len(of)
        v, vb = w, b
        w, b = wy - step * grad, by - step * float(g.sum() + 1e-3 * (by - prior))
    return w, b


class Toxicity:
    def __init__(self, vocabulary: dict[str, float], bias: float):
        self.vocabulary, self.bias = vocabulary, bias

    def score(self, text: str | None) -> float:
        z = self.bias + sum(sorted(self.vocabulary[w] for w in words(text) & self.vocabulary.keys()))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def sampled(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """doc_id, text, toxic of at most ``SAMPLE`` documents of either label, those with the smallest hash of
    their id.  Only ids meet in the choice; the chosen ids, few by their bound, then find their texts in a
    map over the documents.  A repeated id teaches once, by its smallest text."""
    known = marks.where("toxic IN (0, 1)").select("doc_id", "toxic").distinct()
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("_order", F.xxhash64("doc_id"))
    first = [known.where(F.col("toxic") == y).orderBy("_order", "doc_id").limit(SAMPLE) for y in (1, 0)]
    chosen = F.broadcast(first[0].unionByName(first[1]).select("doc_id", "toxic"))  # 2 x SAMPLE rows at most
    return docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def fit(labelled: DataFrame) -> Toxicity:
    """``labelled``: text, toxic (0 or 1), bounded by ``sampled``; all its rows teach.  With no row of a label
    the score is 0.1 for all."""
    sample = labelled.where("toxic IN (0, 1)").select("text", "toxic")
    seen = sample.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower(F.coalesce("text", F.lit(""))), F.lit(r"([\p{L}]+)"), F.lit(1)))).alias("word"))
    counted = seen.groupBy("word").agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
    totals = sample.groupBy("toxic").count().collect()  # two rows
    n = {r["toxic"]: r["count"] for r in totals}
    if not n.get(0) or not n.get(1):
        return Toxicity({}, float(np.log(0.1 / 0.9)))
    share = (F.col("pos") + F.col("neg") + 1) / (n[0] + n[1] + 2)
    gain = F.abs(F.col("pos") / n[1] - F.col("neg") / n[0]) / F.sqrt(share * (1 - share) * (1 / n[1] + 1 / n[0]))
    top = (counted.withColumn("gain", F.round(gain, 9)).where((F.col("pos") + F.col("neg") >= 3) & (F.col("gain") >= SIGNIFICANT))
           .orderBy(F.desc("gain"), "word").limit(FEATURES).select("word").collect())
    vocabulary = sorted({r["word"] for r in top} | SWAP.keys())
    place = {w: i for i, w in enumerate(vocabulary)}

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = lambda t: sorted(place[w] for w in words(t) & place.keys())
        for batch in batches:
            other = [counterfactual(t) for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "ids": [ids(t) for t in batch["text"]],
                                "swapped": [None if t is None else ids(t) for t in other]})

    got = sample.mapInPandas(features, "toxic int, ids array<int>, swapped array<int>").collect()  # 2 x SAMPLE rows of FEATURES small numbers at most
    got.sort(key=lambda r: (r["toxic"], r["ids"]))
    x = np.zeros((len(got), len(vocabulary)), np.float32)
    for i, r in enumerate(got):
        x[i, r["ids"]] = 1
    of = [i for i, r in enumerate(got) if r["swapped"] is not None]
    swapped = np.zeros((len(of), len(vocabulary)), np.float32)
    for j, i in enumerate(of):
        swapped[j, got[i]["swapped"]] = 1
    w, b = train(x, np.array([r["toxic"] for r in got], float), swapped, np.array(of, int))
    return Toxicity({t: round(float(v), 6) for t, v in zip(vocabulary, w, strict=True) if abs(v) > 1e-4}, round(b, 6))


def score(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted of every row; null counts as empty text."""

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            s = np.array([model.score(t) for t in batch["text"]], float)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": s, "predicted": (s >= THRESHOLD).astype(np.int32)})

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInPandas(judge, "doc_id bigint, score double, predicted int")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents.  Null ids keep their rows and teach nothing; repeated ids are scored
    row by row and teach once; labels other than 0 and 1 teach nothing; an empty table gives an empty result."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    marks = labels.where(~held_out()).select("doc_id", "toxic")
    model = fit(staged(sampled(docs, marks), "labelled"))
    out = score(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")
