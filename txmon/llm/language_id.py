"""Language identification by error-correcting output codes over character n-grams.

Every language has a binary codeword; for every bit a binary n-gram classifier (log-likelihood
ratio of the languages with bit 1 against those with bit 0) predicts the bit's margin.  Decoding adds
up, for each codeword, the weighted logistic loss of the margins against its bits; the nearest
codeword wins, and a small lead over the second flags ambiguity.

Training is one distributed pass over all labelled rows outside the held-out fold: every task adds up
n-gram shares per language and sends at most ``BUCKETS`` counts a language.  The model is
``languages x BUCKETS`` numbers, whatever the corpus size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import DOC_COLUMNS, held_out, read

BUCKETS = 1 << 15
CHUNK = 1 << 18
MAX_LANGUAGES = 1000
#: A lead below this share of the score is flagged as ambiguous.
AMBIGUOUS = 0.02
SHARPNESS = 12.0
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def ngram_counts(text: str | None) -> tuple[np.ndarray, bool]:
    """Counts of hashed 1- to 3-grams over the lower-cased letters of the whole text, runs of other
    characters standing as one blank; and whether there is a letter at all."""
    counts, any_letter = np.zeros(BUCKETS), False
    letters = _letter_table()
    text = (text or "").lower()
    for at in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[max(0, at - 2):at + CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
        is_letter = letters[codes]
        if not is_letter.any():
            continue
        any_letter = True
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]
        c = np.where(is_letter, codes, 32).astype(np.uint32)[keep]
        c = np.concatenate(([np.uint32(32)], c))
        h = c * np.uint32(0x9E3779B1)
        two = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + c[1:]
        three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE35) + c[2:]
        for g in (h[1:] ^ np.uint32(0x1234567), two * np.uint32(0x27D4EB2F), three * np.uint32(0x165667B1)):
            counts += np.bincount((g ^ (g >> np.uint32(16))) >> np.uint32(1) & np.uint32(BUCKETS - 1),
                                  minlength=BUCKETS)
    return counts, any_letter


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """n rows of +1/-1: all splits for up to 5 languages, else 8 log2(n) + 8 random bits."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        bits = range(1, 1 << (n - 1))
        return np.array([[1 if k < n - 1 and b >> k & 1 else -1 for b in bits] for k in range(n)], float)
    width = 8 * int(np.ceil(np.log2(n))) + 8
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(n, width))
        apart = ((width - code @ code.T) / 2 + np.eye(n) * width).min()
        balanced = (np.abs(code.sum(axis=0)) < n).all()
        if balanced and apart > far:
            best, far = code, apart
    return code if best is None else best


class Ecoc:
    """Languages, codewords, one weight vector a bit, and the bits' weights in decoding."""

    def __init__(self, languages: list[str], shares: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        total = shares.sum(axis=1, keepdims=True)
        p = (shares / np.maximum(total, 1e-12)) if len(languages) else shares
        smooth = 0.5 / BUCKETS * 1e-2
        rows = []
        for b in range(self.code.shape[1] if len(languages) else 0):
            one, zero = self.code[:, b] > 0, self.code[:, b] < 0
            a = p[one].mean(axis=0) if one.any() else p.mean(axis=0)
            z = p[zero].mean(axis=0) if zero.any() else p.mean(axis=0)
            rows.append(np.clip(np.log((a + smooth) / (z + smooth)), -4, 4))
        self.weights = np.array(rows, np.float32).reshape(-1, BUCKETS)
        margins = p @ self.weights.T  # of each language's mean document
        self.bit_weight = np.maximum((margins * self.code).min(axis=0), 1e-3) if len(languages) else np.ones(0)
        self.bit_weight /= max(self.bit_weight.sum(), 1e-12)

    def decode(self, counts: np.ndarray) -> tuple[str, float, bool]:
        margin = self.weights @ (counts / max(counts.sum(), 1)).astype(np.float32)
        loss = (self.bit_weight * np.logaddexp(0, -self.code * margin * SHARPNESS)).sum(axis=1)
        odds = np.exp(loss.min() - loss)
        score = odds / odds.sum()
        order = np.argsort(-score, kind="stable")
        lead = score[order[0]] - (score[order[1]] if len(order) > 1 else 0)
        return self.languages[order[0]], float(score[order[0]]), bool(lead < AMBIGUOUS)


def fit(labelled: DataFrame) -> Ecoc:
    """``labelled``: text, lang; rows with a null in either, or without a letter, teach nothing.

    More than ``MAX_LANGUAGES`` different values of lang are refused before any text is read.
    """
    known = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    if known.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; the model holds no more")

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                counts, letters = ngram_counts(text)
                if letters:
                    if lang not in sums:
                        sums[lang] = np.zeros(BUCKETS)
                    sums[lang] += counts / counts.sum()
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "share": s[at]})

    # decimals add up to the same sum in any order, so reruns agree
    counted = (known
               .mapInPandas(add_up, "lang string, bucket int, share double")
               .groupBy("lang", "bucket").agg(F.sum(F.col("share").cast("decimal(28,12)")).cast("double").alias("share")))
    rows = counted.toPandas()  # at most MAX_LANGUAGES x BUCKETS numbers, checked above
    languages = sorted(rows["lang"].unique())
    shares = np.zeros((len(languages), BUCKETS))
    place = {lang: i for i, lang in enumerate(languages)}
    shares[rows["lang"].map(place).to_numpy(dtype=int), rows["bucket"].to_numpy(dtype=int)] = rows["share"]
    return Ecoc(languages, shares)


def predict(docs: DataFrame, model: Ecoc, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, then lang_pred, score, ambiguous.

    Null, empty and letterless texts, and every text if nothing was learned, are ``und`` with score 0
    and ambiguous.  Each row is judged by its own text alone.
    """
    names = [f"k{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col(text_col).alias("_text"))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["_text"]:
                counts, letters = ngram_counts(text)
                out.append(model.decode(counts) if letters and model.languages else ("und", 0.0, True))
            yield pd.concat([batch[names], pd.DataFrame(out, columns=["lang_pred", "score", "ambiguous"],
                                                        index=batch.index)], axis=1)

    kept = ", ".join(f"{n} {source.schema[n].dataType.simpleString()}" for n in names)
    judged = source.mapInPandas(judge, f"{kept}, lang_pred string, score double, ambiguous boolean")
    return judged.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)],
                         "lang_pred", "score", "ambiguous")


def identify(docs: DataFrame, keep: list[str]) -> DataFrame:
    return predict(docs, fit(docs.where(~held_out())), keep)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every document; an empty table gives an empty result."""
    out = identify(read(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the method rejects go: those in no language (null, empty and letterless texts).  A text
    between two languages is flagged by the operator but is not rejected."""
    out = identify(docs.select(*DOC_COLUMNS), DOC_COLUMNS)
    return out.where("lang_pred <> 'und'").select(*DOC_COLUMNS)
