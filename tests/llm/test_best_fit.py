import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import best_fit
from daybook.llm.best_fit import (
    END_ID,
    VOCABULARY,
    Encoder,
    best_fit_decreasing,
    feasible_functions,
    lower_bound,
    pack,
)

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def check(tokenizer, rows, found, capacity=1024):
    """Every id of every document once, whole sequences after the first piece, no gaps."""
    left = defaultdict(int)
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            left[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    sequences = defaultdict(list)
    for r in found:
        left[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] -= 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert not any(left.values())
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    lengths = [r.length for r in found]
    return len(sequences), lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)[0]


def test_odd_rows(tokenizer, documents, odd_rows):
    rows = [*odd_rows, (10, "<|endoftext|> named <|endoftext|>", "aa", "s1")]
    check(tokenizer, rows, pack(documents(rows)).collect())


def test_as_few_as_one_task_would_take(tokenizer, documents, prose):
    rows = [(i, prose(i, 5 + 37 * i % 400), "aa", "s") for i in range(600)]
    used, least = check(tokenizer, rows, pack(documents(rows), lot=10_000).collect())
    assert used <= least + 1


def test_exchange_saves_what_small_lots_waste(spark, monkeypatch):
    """Lots of a few dozen pieces lack the partners that other lots have too many of."""
    rng = random.Random(8)
    lengths = [rng.choice([600, 424, 700, 324, 512, 300, 212]) for _ in range(2000)]
    pieces = spark.createDataFrame(
        [(i, i % 700, 0, 0, n, i) for i, n in enumerate(lengths)], best_fit.PIECES
    ).repartition(4)
    turns, counted = [], best_fit._counted
    monkeypatch.setattr(best_fit, "_counted", lambda x: turns.append(counted(x)) or turns[-1])
    found = best_fit.pack_pieces(pieces, lot=60).collect()
    assert sorted((r.ids_crc32, r.length) for r in found) == list(enumerate(lengths))
    held = defaultdict(list)
    for r in found:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        places.sort()
        ends = [a + n for a, n in places]
        assert [a for a, _ in places] == [0, *ends[:-1]] and ends[-1] <= 1024
    least = lower_bound(np.bincount(lengths, minlength=1025), 1024)[0]
    assert len(turns) > 2 and least <= len(held) < turns[0][0]


def test_many_equal_rows_are_dealt_out(tokenizer, documents):
    rows = [(None, "the same words", "aa", "s")] * 500
    found = pack(documents(rows), lot=100).collect()
    used, least = check(tokenizer, rows, found)
    assert least <= used <= 5 and all(r.certified for r in found)


def test_empty_table(documents):
    assert pack(documents([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 60), st.data())
def test_no_sequence_outweighs_a_feasible_function(capacity, data):
    lengths = data.draw(st.lists(st.integers(1, capacity), max_size=40))
    bins, offsets, opened = best_fit_decreasing(sorted(lengths, reverse=True), capacity)
    held = defaultdict(list)
    for length, name, offset in zip(sorted(lengths, reverse=True), bins, offsets):
        assert offset == sum(held[name])
        held[name].append(length)
    assert len(held) == opened and all(sum(x) <= capacity for x in held.values())
    for weights, full in feasible_functions(capacity):
        assert all(weights[x].sum() <= full for x in map(np.array, held.values()))
    histogram = np.bincount(np.array(lengths, int), minlength=capacity + 1)
    assert lower_bound(histogram, capacity)[0] <= opened


def fewest(lengths, capacity):
    """Smallest number of sequences, by trying every place."""
    best = len(lengths)

    def place(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(lengths):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= lengths[at] and rooms[i] not in rooms[:i]:
                place(at + 1, rooms[:i] + [rooms[i] - lengths[at]] + rooms[i + 1 :])
        place(at + 1, rooms + [capacity - lengths[at]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bound_never_exceeds_the_optimum(lengths):
    lengths.sort(reverse=True)
    least, _, _ = lower_bound(np.bincount(lengths, minlength=21), 20)
    assert least <= fewest(lengths, 20) <= best_fit_decreasing(lengths, 20)[2]


def test_ranks_give_the_tokenizers_ids(tokenizer, prose):
    encoder = Encoder(VOCABULARY)
    assert encoder.ranked is not None
    for text in [
        "A  b\n\nc\tD. it's we'LL", "<|endoftext|> a", "É İ Σσς ﬁ K 中文 😀‍😀 가", "\x1c a\x0bb\r\n \x00",
        " ", "   x   ", prose(1, 300), "w" * 3000, " " * 3000, "1234567890" * 50, "",
    ]:
        assert encoder.encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ranks_give_the_tokenizers_ids_for_any_text(text):
    encoder = best_fit._encoder(VOCABULARY)
    assert encoder.encode(text) == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_go_through_the_tokenizer():
    encoder = Encoder("word_bpe_49k.json")
    assert encoder.ranked is None
    assert encoder.encode("Two  words") == encoder.tokenizer.encode("Two  words", add_special_tokens=False).ids
