"""Exact duplicates through counting quotient filters.

Each task counts the 64-bit fingerprints of its rows in a counting quotient
filter: the high bits (quotient) name a block, the low bits (remainder) are kept
sorted inside it, each with its count. Filters of different tasks merge without
loss, block by block, as sorted remainders with added counts. Fingerprints whose
merged count is above one send their rows, and only those, on to a comparison of
the texts themselves, byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import SPACES, bucket_count, small_side, stored

_BLOCK = "quotient long, remainders binary, counts binary"


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


class CountingQuotientFilter:
    """Sorted distinct fingerprints with counts, cut into blocks by their high bits."""

    def __init__(self, quotient_bits: int) -> None:
        self.shift = np.uint64(64 - quotient_bits)
        self.whole = quotient_bits == 0
        self.keys = np.empty(0, np.uint64)
        self.counts = np.empty(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        """Merge fingerprints, each counting once or as given."""
        counts = np.ones(len(keys), np.int64) if counts is None else counts
        keys = np.concatenate([self.keys, keys])
        counts = np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else order
        self.keys = keys[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else counts

    def blocks(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(quotient, sorted remainders, counts) of every block that has rows."""
        if self.whole:
            quotients, remainders = np.zeros(len(self.keys), np.uint64), self.keys
        else:
            quotients = self.keys >> self.shift
            remainders = self.keys & ((np.uint64(1) << self.shift) - np.uint64(1))
        starts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(quotients)], strict=True):
            if b > a:
                yield int(quotients[a]), remainders[a:b].tobytes(), self.counts[a:b].tobytes()


def _partition_filters(quotient_bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cqf = CountingQuotientFilter(quotient_bits)
        for batch in batches:
            cqf.add(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        rows = list(cqf.blocks())
        if rows:
            q, r, c = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(r, pa.binary()), pa.array(c, pa.binary())],
                names=["quotient", "remainders", "counts"],
            )

    return build


def _merge_block(quotient_bits: int):
    def merge(block: pd.DataFrame) -> pd.DataFrame:
        cqf = CountingQuotientFilter(quotient_bits)
        cqf.add(
            np.concatenate([np.frombuffer(x, np.uint64) for x in block["remainders"]]),
            np.concatenate([np.frombuffer(x, np.int64) for x in block["counts"]]),
        )
        many = cqf.counts > 1
        high = np.uint64(block["quotient"].iloc[0]) << cqf.shift if quotient_bits else np.uint64(0)
        return pd.DataFrame(
            {"fp": (cqf.keys[many] | high).view(np.int64), "n": cqf.counts[many]}
        )

    return merge


def repeated_fingerprints(fingerprints: DataFrame, rows: int) -> DataFrame:
    """(fp, n) of the values of a one-column frame that occur more than once.

    A block holds about 20,000 fingerprints, whatever the size of the input: a
    value that fills a third of the rows is one entry per task before the merge.
    """
    bits = (bucket_count(rows) - 1).bit_length()
    blocks = fingerprints.mapInArrow(_partition_filters(bits), _BLOCK)
    return blocks.groupBy("quotient").applyInPandas(_merge_block(bits), "fp long, n long")


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """Every row with the row of its group that stays.

    Takes ``doc_id`` and ``text``; other columns are ignored. Texts are equal when
    they are identical without white space; null counts as empty, so null, empty
    and blank texts form one group. Of a group the row with the most code points
    in the original text stays, then the one with the smallest doc_id (a null
    doc_id loses); of rows that repeat a doc_id as well, one stays. An empty table
    gives no rows. Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    norm = normalised(F.col("text"))
    rows = docs.select(
        "doc_id",
        F.xxhash64(norm).alias("fp"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("len"),
        F.sha2(norm, 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Texts are read once for this and once more to compare those that may be equal.
    marked = stored(rows)
    repeated = stored(repeated_fingerprints(marked.select("fp"), marked.count()).select("fp"))

    # Byte verification: Spark groups by the normalised text itself. Copies in one task
    # meet before the shuffle, so a large group moves one text per task. Only a count is
    # kept beside the text, so this is done by hashing, without sorting texts.
    equal = (
        docs.select(F.xxhash64(norm).alias("fp"), norm.alias("norm"))
        .join(small_side(repeated), "fp")
        .groupBy("fp", "norm")
        .agg(F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("norm", 256).alias("text_sha256"), "group_size")
    )
    equal = small_side(stored(equal))

    # The row that stays, from narrow rows and numbers alone: first its length and
    # doc_id, then the smallest row number, since a row may repeat both.
    grouped = marked.join(equal, "text_sha256").withColumn("top", _precedence("len", "doc_id"))
    first = grouped.groupBy("text_sha256").agg(F.max("top").alias("best"))
    first = small_side(stored(first))
    stays = (
        grouped.join(first, "text_sha256")
        .where(F.col("top") == F.col("best"))
        .groupBy("text_sha256", F.col("doc_id").alias("keep_id"), "group_size")
        .agg(F.min("row").alias("keep_row"))
    )
    stays = small_side(stored(stays))
    alone = F.col("group_size").isNull()
    return marked.join(stays, "text_sha256", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


def _precedence(length: str, doc_id: str) -> Column:
    """A number that grows with the length, then with a smaller doc_id; null is the last id.

    Exact for every 64-bit id: below the length lie the 2^64 places of the ids and null.
    """
    wide = "decimal(38,0)"
    place = F.lit(str(2**63)).cast(wide) - F.col(doc_id).cast(wide)
    return F.col(length).cast("decimal(10,0)") * F.lit(str(2**64 + 1)).cast("decimal(20,0)") + F.coalesce(
        place, F.lit(0).cast(wide)
    )
