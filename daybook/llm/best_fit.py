"""Best-fit packing whose sequence counts are certified by lower bounds.

Documents are dealt into lots, and every lot is packed by best-fit decreasing in
one task. Dual feasible functions give a weight to each length so that no sequence
can hold more than weight 1; the weights of a lot added up are a lower bound on
its sequences. A sequence whose weights are exactly 1 is proven to waste nothing.
The others are the gaps: their documents are exchanged between the lots, by dealing
them anew, and packed again, until the bound of the whole is met or an exchange
saves nothing more.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import bucket_count, discard, stored

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"
# Pieces that one task packs.
LOT = 50_000
# Exchanges at most; one that saves nothing is the last.
ROUNDS = 8
# Staircase functions are tried for this many steps.
STEPS = 20

# Fixed value: the public splitting rule of byte-level vocabularies of this kind.
SPLIT_RULE = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", lot long, bin long, offset long, gap boolean, certified boolean"


def _printable_bytes() -> dict[str, int]:
    """Byte-level vocabularies write byte b as its character, or as 256, 257, ... in turn."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of texts under a tokenizer file.

    Where the file is a plain byte-level vocabulary (checked on load), texts are
    encoded by its ranks, which is several times faster and gives the same ids; a text
    that names a special token, and every text of another vocabulary, goes through
    the tokenizer itself.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        path = vocabulary
        if not os.path.exists(path):
            import public_tokenizers

            path = public_tokenizers.path(vocabulary)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token["content"] for token in told.get("added_tokens") or []]
        self.ranked = self._by_ranks(told)

    def _by_ranks(self, told: dict):
        model, before = told["model"], told.get("pre_tokenizer") or {}
        plain = (
            model.get("type", "BPE") == "BPE"
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not told.get("normalizer")
            and not told.get("truncation")
            and not any(
                model.get(name)
                for name in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
            )
        )
        if not plain:
            return None
        byte_of = _printable_bytes()
        ids = {word: i for word, i in model["vocab"].items() if word not in self.special}
        if any(c not in byte_of for word in ids for c in word):
            return None
        merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        order = [ids.get(m.replace(" ", ""), -1) for m in merged]
        if order != list(range(256, 256 + len(order))) or len(ids) != 256 + len(order):
            return None
        import tiktoken

        ranks = {bytes(byte_of[c] for c in word): i for word, i in ids.items()}
        return tiktoken.Encoding(
            "ranked", pat_str=SPLIT_RULE, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> list[int]:
        if self.ranked is None or any(token in text for token in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)


@cache
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def _pieces(vocabulary: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(vocabulary), np.array([END_ID], "<u4")
        for batch in batches:
            for at in range(0, len(batch), 500):
                part, rows = batch.slice(at, 500), []
                for doc_id, text in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    ids = np.concatenate([np.array(encoder.encode(text or ""), "<u4"), end])
                    # Whole sequences lie at the end, what is left over is first.
                    cuts = [*range(len(ids), 0, -capacity), 0][::-1]
                    for piece, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                        crc = zlib.crc32(ids[start:stop].tobytes())
                        rows.append((doc_id, piece, start, stop - start, crc))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                columns[1] = columns[1].cast(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "piece", "start", "length", "ids_crc32"]
                )

    return run


def token_pieces(
    docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY
) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids; only longer ones are cut.

    ``row`` is a number of its own for every piece, also where doc_id repeats.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(_pieces(vocabulary, capacity), PIECES.split(", ", 1)[1]).select(
        F.monotonically_increasing_id().alias("row"), "*"
    )


def feasible_functions(capacity: int) -> Iterator[tuple[np.ndarray, int]]:
    """(weight of every length from 0 to ``capacity``, weight of a full sequence).

    For each, no lengths that fit together have more than the full weight. All whole
    numbers, so bounds are exact: the length itself; lengths below e left out and
    those above capacity - e counted as whole sequences; staircases of k steps.
    """
    length = np.arange(capacity + 1, dtype=np.int64)
    yield length, capacity
    for e in range(1, capacity // 2 + 1):
        yield np.where(length > capacity - e, capacity, np.where(length < e, 0, length)), capacity
    for k in range(1, STEPS + 1):
        steps = (k + 1) * length
        even = steps % capacity == 0
        yield np.where(even, k * length, capacity * (steps // capacity)), capacity * k


def lower_bound(histogram: np.ndarray, capacity: int) -> tuple[int, np.ndarray, int]:
    """(sequences that these lengths need at least, weights that prove it, full weight).

    ``histogram`` counts the pieces of every length from 0 to ``capacity``. Of equal
    bounds, the one with the larger fraction before rounding up is taken.
    """
    best = None
    counts = [int(n) for n in histogram]
    present = [i for i, n in enumerate(counts) if n]
    for weights, full in feasible_functions(capacity):
        total = sum(counts[i] * int(weights[i]) for i in present)
        if best is None or total * best[2] > best[0] * full:
            best = (total, weights, full)
    total, weights, full = best
    return -(-total // full), weights, full


def best_fit_decreasing(lengths: Sequence[int], capacity: int) -> tuple[list[int], list[int], int]:
    """(sequence, offset) of lengths that come longest first, and the number of sequences.

    Each goes into the fullest sequence that has room. Sequences are kept by their
    room, and one bit per room that occurs finds the smallest that suffices.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, opened = 0, 0
    bins, offsets = [], []
    for length in lengths:
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            name = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, name, opened = capacity, opened, opened + 1
        bins.append(name)
        offsets.append(capacity - room)
        room -= length
        if room:
            by_room[room].append(name)
            rooms |= 1 << room
    return bins, offsets, opened


def _pack_lot(capacity: int):
    def run(lot: pd.DataFrame) -> pd.DataFrame:
        lot = lot.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        lengths = lot["length"].to_numpy()
        bins, offsets, opened = best_fit_decreasing(lengths.tolist(), capacity)
        least, weights, full = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        weight = np.zeros(opened, np.int64)
        np.add.at(weight, bins, weights[lengths])
        return lot.assign(
            bin=np.array(bins, np.int64),
            offset=np.array(offsets, np.int64),
            gap=(weight < full)[bins],
            certified=opened == least,
        )

    return run


def _packed(pieces: DataFrame, count: int, turn: int, capacity: int, lot: int) -> DataFrame:
    """Pieces dealt into lots by a hash of their number and the turn, each lot packed."""
    lots = bucket_count(count, lot)
    dealt = pieces.select(*[f.split()[0] for f in PIECES.split(", ")]).withColumn(
        "lot", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(lots))
    )
    return stored(dealt.groupBy("lot").applyInPandas(_pack_lot(capacity), PLACED))


def _counted(placed: DataFrame) -> tuple[int, int, int]:
    """(sequences, sequences with a gap, pieces in those)."""
    first = F.col("offset") == 0
    row = placed.agg(
        F.count_if(first), F.count_if(first & F.col("gap")), F.count_if("gap")
    ).first()
    return tuple(row)


def pack(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    lot: int = LOT,
) -> DataFrame:
    """Place every document into sequences of at most ``capacity`` ids, as few as it can.

    Documents are tokenized once; the pieces are packed by ``pack_pieces``.

    Takes ``doc_id`` and ``text``; other columns are ignored. A null or empty text
    has the closing id only. Rows that repeat are packed one by one, and many equal
    rows are dealt out like others. An empty table gives no rows. A text longer than a
    sequence gives whole sequences and one shorter piece, its first.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset, with
    ``certified``: whether the lot that the piece was last packed in reached its lower
    bound.
    """
    return pack_pieces(stored(token_pieces(docs, vocabulary, capacity)), capacity, lot)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, lot: int = LOT) -> DataFrame:
    """Place pieces of known length; ``row`` numbers them.

    Rows of 44 bytes move, and in each exchange only those of sequences with a gap.
    """
    # At most one row per length.
    histogram = np.zeros(capacity + 1, np.int64)
    for length, count in pieces.groupBy("length").count().collect():
        histogram[length] = count
    histogram[capacity] = 0  # whole sequences are packed as they are
    least, _, _ = lower_bound(histogram, capacity)

    short = pieces.where(F.col("length") < capacity)
    placed = _packed(short, int(histogram.sum()), 0, capacity, lot)
    done: list[tuple[int, DataFrame]] = []
    used, gaps, loose = _counted(placed)
    lots = bucket_count(int(histogram.sum()), lot)
    for turn in range(1, ROUNDS + 1):
        if used <= least or lots == 1:
            break
        lots = bucket_count(loose, lot)
        again = _packed(placed.where("gap"), loose, turn, capacity, lot)
        now, now_gaps, now_loose = _counted(again)
        if now >= gaps:
            discard(again)
            break
        done.append((turn, placed.where("not gap")))
        placed, used, gaps, loose = again, used - gaps + now, now_gaps, now_loose
    done.append((0, placed))

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified"]
    result = pieces.where(F.col("length") == capacity).select(
        "*", (-F.col("row") - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"),
    ).select(columns)
    for turn, part in done:
        name = F.shiftleft(F.lit(turn).cast("long"), 58) + F.shiftleft("lot", 20) + F.col("bin")
        result = result.unionByName(part.withColumn("sequence_id", name).select(columns))
    return result
