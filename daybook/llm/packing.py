"""Pack token sequences by harmonic classes.

A document's ids are cut into whole sequences and pieces of the lengths
capacity / 2, / 3, ... / 16; what is left after those is shorter than the last
of them. A piece of class i is at most capacity / i long, so any i of them fill
one sequence: no task has to know what another one packs. Pieces are numbered
within their class and every i in a row share a sequence. The last, unfilled
sequence of each class would be padded; these pieces, fewer than the classes'
sizes added up and so bounded by the capacity alone, are packed together.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.best_fit import _printable_bytes
from daybook.llm.common import bucket_count, releasing, stored, unit, with_running_total

CAPACITY = 4096
FINEST = 16
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
# Words a worker remembers the ids of, twice: beyond that, those not used lately are forgotten.
REMEMBERED = 300_000
# Stands between words that are encoded together: a word that is always one id.
BETWEEN = "0"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# How the public vocabulary with word ends prepares and splits a text.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
# Words of these characters are changed by no normalizer; what the rule makes of them.
_SIMPLE = re.compile("[!-~ß-öø-ÿ]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ a-z0-9ß-öø-ÿ]+")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cuts(capacity: int = CAPACITY, finest: int = FINEST) -> list[list[int]]:
    """Piece lengths for every remainder below ``capacity``."""
    table: list[list[int]] = []
    for rest in range(capacity):
        pieces = []
        while rest * finest > capacity:
            piece = capacity // -(-capacity // rest)
            pieces.append(piece)
            rest -= piece
        table.append(pieces + [rest] * (rest > 0))
    return table


def _by_ranks(told: dict):
    """An encoder of parts that each end in a space, or None if the file is of another kind.

    A space, which no part of a word holds, stands for the word end. Its symbols rank
    before all merges, so the last byte of a part meets it first, as in the file.
    """
    model, steps = told["model"], (told.get("normalizer") or {}).get("normalizers", [])
    before = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
    plain = (
        model.get("type", "BPE") == "BPE"
        and model.get("end_of_word_suffix") == WORD_END
        and [step["type"] for step in steps] == NORMALIZERS
        and [step["type"] for step in before] == ["Split", "ByteLevel"]
        and before[0]["pattern"] == {"Regex": SPLIT_RULE}
        and before[0]["behavior"] == "Removed" and before[0]["invert"]
        and not before[1].get("add_prefix_space") and not before[1].get("use_regex", True)
        and not told.get("truncation")
        and not any(model.get(name) for name in ("dropout", "continuing_subword_prefix", "ignore_merges"))
    )
    if not plain:
        return None
    byte_of = _printable_bytes()
    special = {token["content"] for token in told.get("added_tokens") or []}
    ids = {word: i for word, i in model["vocab"].items() if word not in special}
    merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    order = [ids.get(m.replace(" ", ""), -1) for m in merged]
    if order != list(range(512, 512 + len(order))) or len(ids) != 512 + len(order):
        return None
    ranks = {}
    for word, i in ids.items():
        letters = word.removesuffix(WORD_END)
        if any(c not in byte_of for c in letters):
            return None
        ranks[bytes(byte_of[c] for c in letters) + b" " * (letters != word)] = i
    import tiktoken

    return tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})


class WordIds:
    """Ids of a text as little-endian 32-bit bytes, word by word with a memory.

    The vocabulary splits at white space and lower-cases, so the ids of a text are
    those of its words, one after the other, and capitals in A-Z make no difference
    but in the names of special tokens. Words that are new are encoded many at a
    time, with a word of one id between them: by the ranks of the file, if it is of
    the known kind and they are of simple characters, which is several times faster
    and gives the same ids, else by the tokenizer. A vocabulary that does otherwise,
    as seen on a few words when it is loaded, encodes whole texts.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = vocabulary
        if not os.path.exists(path):
            import public_tokenizers

            path = public_tokenizers.path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.ranked = _by_ranks(json.load(file))
        self.between = self._ids([BETWEEN])[0]
        whole, *words = self._ids([" One two\n THREE, 4 ", "one", "two", "three,", "4"])
        self.by_word = whole == b"".join(words)
        self.memory: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._ids(texts)
        split = []
        for text in texts:
            if "<|" in text:
                pass
            elif text.isascii():
                text = text.lower()
            else:
                text = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
            split.append(text.replace("\n", " ").split(" "))
        if len(self.memory) > REMEMBERED:
            self.older, self.memory = self.memory, {"": b""}
        memory, older = self.memory, self.older
        new = set().union(*split).difference(memory)
        memory.update((word, older[word]) for word in new if word in older)
        self._learn(new.difference(memory))
        return [b"".join(map(memory.__getitem__, words)) for words in split]

    def _learn(self, words: set[str]) -> None:
        # Where "0" is several ids, as in another vocabulary, one word at a time.
        apart = len(self.between) == 4
        plain = [w for w in words if apart and BETWEEN not in w and "<|" not in w]
        simple = [w for w in plain if self.ranked and _SIMPLE.fullmatch(w)]
        self._learn_together(simple, self._ranked_ids)
        if len(simple) < len(plain):
            self._learn_together(list(set(plain).difference(simple)), self._ids)
        odd = list(words.difference(plain))
        for at in range(0, len(odd), 1000):
            part = odd[at : at + 1000]
            self.memory.update(zip(part, self._ids(part), strict=True))

    def _ranked_ids(self, texts: list[str]) -> list[bytes]:
        parts = (" ".join(_PARTS.findall(text)) + " " for text in texts)
        return [np.array(self.ranked.encode_ordinary(part), "<u4").tobytes() for part in parts]

    def _learn_together(self, words: list[str], ids_of: Callable[[list[str]], list[bytes]]) -> None:
        together = ids_of([f" {BETWEEN} ".join(words[at : at + 500]) for at in range(0, len(words), 500)])
        mark = int.from_bytes(self.between, "little")
        for at, data in enumerate(together):
            part = words[500 * at : 500 * (at + 1)]
            cut = 4 * np.flatnonzero(np.frombuffer(data, "<u4") == mark)
            starts, ends = np.r_[0, cut + 4], np.r_[cut, len(data)]
            for word, a, b in zip(part, starts.tolist(), ends.tolist(), strict=True):
                self.memory[word] = data[a:b]


def _pieces(vocabulary: str, capacity: int, finest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = WordIds(vocabulary), cuts(capacity, finest)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), 200):
                part, rows = batch.slice(at, 200), []
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = part.column(0).to_pylist()
                for doc_id, encoded in zip(ids, encoder.encode(texts), strict=True):
                    encoded += end
                    total, start = len(encoded) // 4, 0
                    whole, rest = divmod(total, capacity)
                    for length in [capacity] * whole + table[rest]:
                        crc = zlib.crc32(encoded[4 * start : 4 * (start + length)])
                        rows.append((doc_id, start, length, crc, total))
                        start += length
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                )

    return run


def token_pieces(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    finest: int = FINEST,
) -> DataFrame:
    """Documents cut into pieces: doc_id, start, length, ids_crc32, doc_tokens."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(releasing(_pieces(vocabulary, capacity, finest)), PIECES)


def _fill_together(capacity: int):
    """Pack the bounded rest, longest first, into the fullest sequence with room."""

    def run(rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.drop(columns="all").sort_values(
            ["length", "doc_id", "start"], ascending=[False, True, True]
        ).reset_index(drop=True)
        room: list[tuple[int, int]] = []
        bins, offsets, opened = [], [], 0
        for length in rest["length"]:
            at = bisect_left(room, (length, -1))
            if at < len(room):
                free, name = room.pop(at)
            else:
                free, name, opened = capacity, opened, opened + 1
            bins.append(name)
            offsets.append(capacity - free)
            if free > length:
                insort(room, (free - length, name))
        return rest.assign(bin=np.array(bins, "int64"), offset=np.array(offsets, "int64"))

    return run


def pack(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    finest: int = FINEST,
) -> DataFrame:
    """Place every id of every document into sequences of at most ``capacity`` ids.

    Takes ``doc_id`` and ``text``; other columns are ignored. A null or empty text
    has the closing id only. Rows that repeat are packed one by one. An empty table
    gives no rows. Returns the pieces with sequence_id and offset; the pieces of a
    sequence follow each other from offset 0 without gaps.
    """
    pieces = stored(
        token_pieces(docs, vocabulary, capacity, finest).withColumn(
            "per_bin", F.floor(F.lit(capacity) / F.col("length")).cast("int")
        )
    )
    # At most one row per possible class size, so no more than ``capacity`` rows.
    counts = {r["per_bin"]: r["count"] for r in pieces.groupBy("per_bin").count().collect()}
    spark, first, classes = docs.sparkSession, 0, []
    for per_bin, count in sorted(counts.items()):
        classes.append((per_bin, count - count % per_bin, first))
        first += count // per_bin
    known = spark.createDataFrame(classes, "class int, full long, first_bin long")

    numbered = with_running_total(
        pieces, "number", ["per_bin"], unit("doc_id", "start"),
        ["doc_id", "start", "ids_crc32"], F.lit(1).cast("long"), bucket_count(sum(counts.values())),
    ).join(F.broadcast(known), F.col("per_bin") == F.col("class"))
    in_bin = Window.partitionBy("sequence_id").orderBy("number").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    filled = (
        numbered.where("number < full")
        .withColumn("sequence_id", F.col("first_bin") + F.floor(F.col("number") / F.col("per_bin")))
        .withColumn("offset", F.sum("length").over(in_bin) - F.col("length"))
        .select(columns)
    )
    rest = (
        numbered.where("number >= full")
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.lit(0).alias("all"))
        .groupBy("all")
        .applyInPandas(_fill_together(capacity), PIECES + ", bin long, offset long")
        .withColumn("sequence_id", F.col("bin") + first)
        .select(columns)
    )
    return filled.unionByName(rest)
