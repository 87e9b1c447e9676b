from collections import defaultdict
from functools import cache
import zlib

import numpy as np
import pytest

from daybook.llm import packing
from daybook.llm.packing import WordIds, cuts, pack, VOCABULARY

public_tokenizers = pytest.importorskip("public_tokenizers")


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def encode(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, found, capacity=4096):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    copies = defaultdict(list)
    for i, text, *_ in rows:
        copies[i].append(encode(text))
    assert set(docs) == set(copies)
    for i, texts in copies.items():
        want = defaultdict(int)
        for ids in texts:
            want[len(ids)] += len(ids)
        have = defaultdict(int)
        for r in docs[i]:
            have[r.doc_tokens] += r.length
            fits = [ids for ids in texts if len(ids) == r.doc_tokens]
            piece = [np.array(ids[r.start : r.start + r.length], "<u4").tobytes() for ids in fits]
            assert r.ids_crc32 in map(zlib.crc32, piece)
        assert have == want
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return sum(r.length for r in found) / (capacity * len(sequences))


def test_odd_rows(documents, odd_rows):
    check(odd_rows, pack(documents(odd_rows)).collect())


def test_little_padding(documents, prose):
    rows = [(i, prose(i, 10 + 37 * i % 900), "aa", "s") for i in range(400)]
    assert check(rows, pack(documents(rows)).collect()) > 0.97


def test_empty_table(documents):
    assert pack(documents([])).count() == 0


def test_cuts_add_up():
    for rest, pieces in enumerate(cuts(4096)):
        assert sum(pieces) == rest and all(p > 0 for p in pieces) and len(pieces) <= 8


def test_word_ids_are_the_tokenizers(prose):
    texts = [
        "A  b\n\nc\tD.", "x0y 0 00", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "don't We'LL",
        "É É İ Σσς ﬁ K", "\x1c a\x0bb\r\n", "中文 😀‍😀 가", "", " ", prose(1, 300), "w" * 3000,
    ]
    words = WordIds(VOCABULARY)
    for text, data in zip(texts * 2, words.encode(texts) + words.encode(texts), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == encode(text)[:-1]


def test_ranks_give_the_ids_of_the_tokenizer(prose):
    from random import Random

    words = WordIds(VOCABULARY)
    assert words.ranked
    random = Random(7)
    letters = "aaeinorst'-.,!<|>/_~`0159ßéñüçÉÑ×÷ªµ\u0301\x7f\x85\xa0Ǆŉǆ中"
    odd = ["".join(random.choices(letters, k=random.randint(1, 14))) for _ in range(20_000)]
    texts = [" ".join(odd[at : at + 100]) for at in range(0, len(odd), 100)]
    texts += [prose(seed, 500).upper() for seed in range(5)]
    texts += ["don't we'll 's'd 'SHE'D'S it''s o'", "a" * 500 + " " + "ab" * 3000 + "!" * 400]
    for text, data in zip(texts, words.encode(texts), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == encode(text)[:-1]


def test_words_are_forgotten_and_learned_again(prose, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    words = WordIds(VOCABULARY)
    for seed in (1, 2, 1, 3, 1):
        data = words.encode([prose(seed, 30)])[0]
        assert np.frombuffer(data, "<u4").tolist() == encode(prose(seed, 30))[:-1]
        assert len(words.memory) + len(words.older) < 100


def test_a_vocabulary_that_keeps_spaces_encodes_whole_texts():
    from tokenizers import Tokenizer

    other = "byte_bpe_50k.json"
    plain = Tokenizer.from_file(public_tokenizers.path(other))
    texts = ["A  b\n\nc\tD.", "two words", ""]
    for text, data in zip(texts, WordIds(other).encode(texts), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert WordIds(VOCABULARY).by_word
