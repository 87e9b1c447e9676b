"""Language of a text by sparse logistic regression on character n-grams.

Letters are lower-cased and everything else is a gap; n-grams of one to three
characters are hashed to a fixed number of features and weighted by TF-IDF.
Multinomial logistic regression is trained with follow-the-regularised-leader and
elastic-net penalties, which leave most weights zero; a temperature fitted on
documents kept aside makes the scores probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import releasing
from daybook.llm.sampling import labelled_sample

FEATURES = 1 << 16
UNKNOWN = "und"
# Characters worked on at a time: bounds memory for long texts, and fits a cache.
WINDOW = 1 << 15

ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.01
EPOCHS = 3
SCALE = 20.0


class Grams:
    """Hashed n-grams of texts, a bounded stretch of characters at a time."""

    def __init__(self) -> None:
        self.letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)

    def codes(self, text: str) -> np.ndarray:
        """Lower-case code points, 0 for anything that is no letter; gaps are one long."""
        lowered = text.lower().encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(lowered, "<u4")
        points = np.where(self.letter[points], points, 0)
        keep = points != 0
        keep[1:] |= points[:-1] != 0
        return points[keep]

    def stretches(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text number, code) of all characters, with a gap around every text."""
        at, rows, parts, size = 0, [], [], 0
        for at, text in enumerate(texts):
            codes = self.codes(text) if text else np.empty(0, np.uint32)
            for start in range(0, len(codes), WINDOW):
                # The two characters before count again, so that no n-gram is lost.
                part = np.concatenate([[0], codes[max(0, start - 2) : start + WINDOW], [0]])
                rows.append(np.full(len(part), at))
                parts.append(part.astype(np.uint32))
                size += len(part)
                if size >= WINDOW:
                    yield np.concatenate(rows), np.concatenate(parts)
                    rows, parts, size = [], [], 0
        if parts:
            yield np.concatenate(rows), np.concatenate(parts)

    @staticmethod
    def hashed(rows: np.ndarray, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text number, feature) of all n-grams that lie inside one text."""
        mixed = codes * np.uint32(0x9E3779B1)
        gram = mixed
        for order in (1, 2, 3):
            if order > 1:
                gram = (gram[:-1] * np.uint32(0x85EBCA77)) ^ mixed[order - 1 :]
            spread = (gram ^ (gram >> np.uint32(15)) ^ np.uint32(order)) * np.uint32(0xC2B2AE3D)
            owner = rows[: len(gram)]
            inside = owner == rows[order - 1 :]
            yield owner[inside], (spread >> np.uint32(16))[inside]


@dataclass
class LanguageModel:
    langs: list[str]
    weights: np.ndarray = field(repr=False)  # languages x features, with IDF multiplied in
    bias: np.ndarray = field(repr=False)
    temperature: float = 1.0

    def logits(self, texts: list[str | None], grams: Grams) -> tuple[np.ndarray, np.ndarray]:
        """Logits per text, and which texts have a letter."""
        total = np.zeros((len(texts), len(self.langs)))
        seen = np.zeros(len(texts))
        letters = np.zeros(len(texts))
        for rows, codes in grams.stretches(texts):
            letters += np.bincount(rows[codes != 0], minlength=len(texts))
            for owner, features in grams.hashed(rows, codes):
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                if len(first):
                    for k, column in enumerate(self.weights):
                        total[owner[first], k] += np.add.reduceat(column[features], first)
                    seen[owner[first]] += np.diff(np.r_[first, len(owner)])
        return SCALE * total / np.maximum(seen, 1)[:, None] + self.bias, letters > 0

    def predict(self, texts: list[str | None], grams: Grams) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        logits, known = self.logits(texts, grams)
        p = _softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        langs = [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)]
        return langs, np.where(known, p[np.arange(len(p)), best], 0.0)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sparse(text: str, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
    """Features of one text and their term frequencies."""
    counts = np.zeros(FEATURES)
    for rows, codes in grams.stretches([text]):
        for _, features in grams.hashed(rows, codes):
            counts += np.bincount(features, minlength=FEATURES)
    at = np.flatnonzero(counts)
    return at.astype(np.int32), counts[at] / max(1.0, counts.sum())


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, counts, docs = Grams(), np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen = np.zeros(FEATURES, bool)
            for rows, codes in grams.stretches([text]):
                for _, features in grams.hashed(rows, codes):
                    seen[features] = True
            counts += seen
            docs += 1
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[at, -1], pa.int64()), pa.array(np.r_[counts[at], docs], pa.int64())],
        names=["feature", "n"],
    )


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """IDF of every feature over all texts of a one-column frame.

    Each task sends one row per feature it has seen, so the result and what is
    shuffled are bounded by the number of features.
    """
    found = texts.mapInArrow(_document_counts, "feature long, n long")
    sums = dict(found.groupBy("feature").agg(F.sum("n")).collect())
    docs = sums.pop(-1, 0) or 0
    counts = np.zeros(FEATURES)
    for feature, n in sums.items():
        counts[feature] = n
    return np.log((1 + docs) / (1 + counts)) + 1


def fit_language(sample: pd.DataFrame, idf: np.ndarray, seed: int = 5) -> LanguageModel:
    """Train on text and lang; every fifth document is kept for the temperature."""
    langs = sorted(set(sample["lang"]))
    if len(langs) < 1:
        return LanguageModel([], np.zeros((0, FEATURES)), np.zeros(0))
    grams, size = Grams(), len(langs)
    target = np.searchsorted(langs, sample["lang"])
    rows = [_sparse(text, grams) for text in sample["text"]]
    rows = [(at, SCALE * tf * idf[at]) for at, tf in rows]
    aside = sample["document"].to_numpy(dtype=int) % 5 == 4
    z, n = np.zeros((FEATURES + 1, size)), np.zeros((FEATURES + 1, size))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        """Proximal step: zero inside the L1 ball, shrunk by L2 outside; no penalty on the bias."""
        zs, rate = z[at], (BETA + np.sqrt(n[at])) / ALPHA
        return np.where(np.abs(zs) > L1, -(zs - np.sign(zs) * L1) / (rate + L2), 0.0)

    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(np.flatnonzero(~aside)):
            at, x = rows[i]
            at, x = np.r_[at, FEATURES], np.r_[x, 1.0]
            w = weights(at)
            p = _softmax((x @ w)[None, :])[0]
            p[target[i]] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(slice(None))
    model = LanguageModel(langs, np.ascontiguousarray((w[:-1] * idf[:, None]).T), w[-1])
    if aside.any():
        logits = np.array([x @ w[at] + w[-1] for (at, x), a in zip(rows, aside, strict=True) if a])
        goal = target[aside]
        loss = lambda t: -np.log(_softmax(logits / t)[np.arange(len(goal)), goal] + 1e-12).mean()
        model.temperature = float(min(np.geomspace(0.05, 20, 200), key=loss))
    return model


def learn_language(docs: DataFrame) -> LanguageModel:
    """Fit on ``text`` and non-null ``lang``: IDF over all rows, weights on a bounded sample."""
    texts = docs.where("text is not null and lang is not null")
    return fit_language(labelled_sample(texts, "lang"), inverse_frequencies(texts.select("text")))


def language_of(model: LanguageModel):
    """A column function: the text's language and score, as a struct (lang, score)."""

    @F.pandas_udf("lang string, score double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from releasing(scored)(parts)

    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams = Grams()
        for texts in parts:
            langs, scores = model.predict(list(texts), grams)
            yield pd.DataFrame({"lang": langs, "score": scores})

    return run


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every whole text.

    Takes ``doc_id`` and ``text``; other columns are ignored. A text that is null
    or has no letter is ``und`` with score 0, as is every text if no language was
    learned. Rows that repeat are answered one by one; an empty table gives no rows.
    """
    found = docs.select("doc_id", language_of(model)("text").alias("found"))
    return found.select(
        "doc_id", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )
