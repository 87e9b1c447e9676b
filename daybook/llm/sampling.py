"""Bounded samples of labelled rows for fitting classifiers on the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import unit

SAMPLE_ROWS = 6_000
# Longer texts give this many stretches of this many characters, one from each part of the text.
WHOLE_CHARS = 20_000
STRETCHES, STRETCH_CHARS = 5, 2_000
# Characters drawn in all, about.
SAMPLE_CHARS = 24_000_000


def _stretches(text: str = "text"):
    """The text, or if it is long, stretches of it at hashed places, as an array."""
    part = (F.length(text) - STRETCH_CHARS) / STRETCHES
    places = [F.floor((unit("doc_id", F.lit(k)) + k) * part).cast("int") + 1 for k in range(STRETCHES)]
    drawn = [F.col(text).substr(place, F.lit(STRETCH_CHARS)) for place in places]
    return F.when(F.length(text) <= WHOLE_CHARS, F.array(text)).otherwise(F.array(*drawn))


def labelled_sample(
    docs: DataFrame,
    label: str,
    rows: int = SAMPLE_ROWS,
    chars: int = SAMPLE_CHARS,
    length: Column | None = None,
) -> pd.DataFrame:
    """About ``rows`` labelled documents or ``chars`` characters at most, alike per label.

    Labels, their counts and characters are read over all rows, whatever the length;
    each label then gives the documents with the smallest hashes of doc_id, so reruns
    agree. A long text gives several stretches, each a row. Returns doc_id, text, the
    label and the number of the document that the row is from. ``length`` is a column with
    the text's length where ``docs`` is a join, which then counts without moving texts.
    """
    fit = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull())
    length = F.length("text") if length is None else length
    fit = fit.where(length > 0).select("doc_id", "text", label, length.alias("_length"))
    length = F.col("_length")
    drawn = F.when(length <= WHOLE_CHARS, length).otherwise(STRETCHES * STRETCH_CHARS)
    counts = fit.groupBy(label).agg(F.count("*").alias("n"), F.sum(drawn).alias("chars")).collect()
    if not counts:
        return pd.DataFrame({"doc_id": [], "text": [], label: [], "document": []})
    wanted = F.lit(False)
    for count in counts:
        share = min(1.0, rows / len(counts) / count["n"], chars / len(counts) / count["chars"])
        wanted = wanted | ((F.col(label) == F.lit(count[label])) & (unit("doc_id", F.lit(label)) < share))
    found = fit.where(wanted).select("doc_id", _stretches().alias("text"), label).toPandas()
    found["order"] = found["text"].map("".join)
    found = found.sort_values(["doc_id", "order"]).drop(columns="order")
    found["document"] = range(len(found))
    return found.explode("text").reset_index(drop=True)


def remainder(divisor: int):
    """crc32 of doc_id as text, modulo ``divisor``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor
