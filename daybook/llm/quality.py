"""Text quality from what two compression dictionaries save.

One zstandard dictionary is built from text labelled good, one from text labelled
bad. A text is cut into blocks, so that a dictionary matters all along it, and all
blocks are compressed with either. The difference of the two sizes over their sum,
with the compression ratio beside it, goes through a logistic curve fitted on
labelled text that built neither dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.sampling import labelled_sample

DICTIONARY_BYTES = 32_768
BLOCK_BYTES = 1_024
LEVEL = 1
# Blocks that build one dictionary, at most.
TRAINING_BLOCKS = 20_000


def _blocks(text: str) -> list[bytes]:
    data = text.encode("utf-8", "replace")
    return [data[at : at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)]


@dataclass
class QualityModel:
    """Two dictionaries (bad, good) and the curve over (difference, ratio, 1)."""

    dictionaries: tuple[bytes, bytes] | None
    curve: tuple[float, float, float]
    prior: float

    def compressors(self) -> list:
        import zstandard

        found = []
        for data in self.dictionaries or ():
            known = zstandard.ZstdCompressionDict(data)
            known.precompute_compress(level=LEVEL)
            found.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=known, write_content_size=False,
                    write_checksum=False, write_dict_id=False,
                )
            )
        return found

    def features(self, text: str, compressors: list) -> tuple[float, float]:
        blocks = _blocks(text)
        size = sum(map(len, blocks))
        if not size:
            return 0.0, 0.0
        bad, good = (sum(len(c.compress(b)) for b in blocks) for c in compressors)
        return (bad - good) / (bad + good), (bad + good) / (2 * size)

    def scores(self, texts: list[str | None], compressors: list) -> np.ndarray:
        """Chance of label 1; the share of label 1 where there is nothing to compress."""
        out = np.full(len(texts), self.prior)
        if self.dictionaries is None:
            return out
        for i, text in enumerate(texts):
            if text:
                d, r = self.features(text, compressors)
                out[i] = 1 / (1 + np.exp(-np.clip(np.dot(self.curve, (d, r, 1.0)), -35, 35)))
        return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton's method on standardised columns; the last column is the constant."""
    centre, scale = x.mean(0), x.std(0) + 1e-12
    centre[-1], scale[-1] = 0.0, 1.0
    z, w = (x - centre) / scale, np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        hessian = (z.T * (weight * p * (1 - p))) @ z + ridge * np.eye(len(w))
        w -= np.linalg.solve(hessian, z.T @ (weight * (p - y)) + ridge * w)
    w = w / scale
    w[-1] -= float(centre[:-1] @ w[:-1])
    return w


def _halved(sample: pd.DataFrame) -> pd.DataFrame:
    """The sample with the only document of a label, if so, cut into two documents."""
    parts = []
    for _, rows in sample.groupby("quality"):
        if rows["document"].nunique() == 1:
            text = "".join(rows["text"])
            halves = [h for h in (text[: len(text) // 2], text[len(text) // 2 :]) if h]
            rows = rows.iloc[[0] * len(halves)].assign(text=halves)
            rows["document"] = [rows["document"].iloc[0] - k / 2 for k in range(len(halves))]
        parts.append(rows)
    return pd.concat(parts).sort_values("document", kind="stable", ignore_index=True)


def fit_quality(sample: pd.DataFrame, shares: dict[int, float] | None = None) -> QualityModel:
    """Fit on text and quality (0 or 1): every other document of a label builds its
    dictionary, the rest the curve; a label with one document gives half of it to either.

    Rows from one document, stretches of a long text, share its weight in the curve.
    ``shares`` gives the share of each label over all labelled rows, to undo a
    sample that is alike per label. With one label only, every score is its share.
    """
    import zstandard

    if not len(sample):
        return QualityModel(None, (0.0, 0.0, 0.0), 0.5)
    prior = shares.get(1, 0.0) if shares else float(sample["quality"].mean())
    sample = _halved(sample)
    labels = sample["quality"].to_numpy(dtype=float)
    # Documents are numbered within their label, so that either side gets some of it.
    even = sample.groupby("quality")["document"].rank(method="dense").to_numpy(dtype=int) % 2 == 1
    dictionaries = []
    for label in (0, 1):
        texts = sample["text"][(labels == label) & even]
        blocks = [b for text in texts for b in _blocks(text)]
        blocks = blocks[:: max(1, -(-len(blocks) // TRAINING_BLOCKS))]
        if not blocks:
            return QualityModel(None, (0.0, 0.0, 0.0), prior)
        built = b"".join(blocks)[-DICTIONARY_BYTES:]
        if len(blocks) >= 16:
            with suppress(zstandard.ZstdError):  # too little text to choose from: take it as it is
                built = zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
        dictionaries.append(built)
    if sample["quality"][~even].nunique() < 2:
        return QualityModel(None, (0.0, 0.0, 0.0), prior)
    model = QualityModel(tuple(dictionaries), (0.0, 0.0, 0.0), prior)
    curve_rows = sample[~even]
    compressors = model.compressors()
    x = np.array([(*model.features(t, compressors), 1.0) for t in curve_rows["text"]])
    y = curve_rows["quality"].to_numpy(dtype=float)
    if 0 < y.sum() < len(y):
        weight = 1 / curve_rows.groupby("document")["text"].transform("size").to_numpy(dtype=float)
        w = _logistic(x, y, weight)
        drawn = float(np.average(y, weights=weight))
        w[-1] += np.log(prior / (1 - prior)) - np.log(drawn / (1 - drawn)) if 0 < prior < 1 else 0
        model.curve = tuple(float(v) for v in w)
    return model


def _score(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = model.compressors()
        for batch in batches:
            scores = model.scores(batch.column(1).to_pylist(), compressors)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    return run


def learn_quality(docs: DataFrame, labels: DataFrame, learnable) -> QualityModel:
    """Fit on a bounded sample of the labelled documents that ``learnable`` admits.

    A null quality is no label. Several labels of one document count as its highest.
    """
    marks = labels.where("quality is not null").groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("quality")
    )
    texts = docs.select("doc_id", "text", F.length("text").alias("_chars"))
    known = texts.where(learnable).join(marks, "doc_id")
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    total = sum(counts.values()) or 1
    shares = {label: n / total for label, n in counts.items()}
    return fit_quality(labelled_sample(known, "quality", length=F.col("_chars")), shares)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text.

    Takes ``doc_id`` and ``text``; other columns are ignored. A null or empty text
    scores the share of good labels. Rows that repeat are scored one by one; an
    empty table gives no rows; without a labelled text of both kinds (of two
    characters at least if it is the only one) all score alike. A label with fewer than 16 blocks of 1 KB gives them as its dictionary as they are.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score(model), "doc_id long, score double")
