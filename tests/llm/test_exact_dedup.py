import hashlib
import random
import re
from collections import defaultdict

import numpy as np

from daybook.llm.exact_dedup import CountingQuotientFilter, duplicate_groups


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    out = []
    for text, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1] is None, m[1] or 0))[1]
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(members), digest) for _, i in members]
    return sorted(out, key=str)


def answer(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def test_odd_rows(documents, odd_rows):
    found = duplicate_groups(documents(odd_rows)).cache()
    assert answer(found) == brute(odd_rows)
    kept = [r.text_sha256 for r in found.where("kept").collect()]
    assert len(kept) == len(set(kept)) == len({d for *_, d in brute(odd_rows)})


def test_many_copies(documents, prose):
    rng = random.Random(4)
    texts = [prose(i, 8) for i in range(40)] + [prose(7, 8).replace(" ", "\n")] * 5
    rows = [(i, texts[0] if i % 3 == 0 else rng.choice(texts), "aa", "s") for i in range(600)]
    assert answer(duplicate_groups(documents(rows))) == brute(rows)


def test_empty_table(documents):
    assert duplicate_groups(documents([])).count() == 0


def test_filters_merge_without_loss():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**64, 500, dtype=np.uint64)
    keys = np.concatenate([keys, keys[:100], keys[:30]])
    for bits in (0, 3, 8):
        merged = CountingQuotientFilter(bits)
        for part in np.array_split(rng.permutation(keys), 7):
            one = CountingQuotientFilter(bits)
            one.add(part)
            for q, remainders, counts in one.blocks():
                high = np.uint64(q) << one.shift if bits else np.uint64(0)
                merged.add(np.frombuffer(remainders, np.uint64) | high, np.frombuffer(counts, np.int64))
        values, counts = np.unique(keys, return_counts=True)
        assert (merged.keys == values).all() and (merged.counts == counts).all()


def test_any_64_bit_id_and_many_rows_without_one(documents):
    low, high = -(2**63), 2**63 - 1
    rows = [(low, "a b", "aa", "s"), (high, "ab", "aa", "s"), (0, "a  b", "aa", "s"), (None, " a b ", "aa", "s")]
    rows += [(low, "ties", "aa", "s"), (high, "ties", "aa", "s"), (None, "ties", "aa", "s")]
    rows += [(None, "without", "aa", "s")] * 300 + [(7, None, "aa", "s"), (low, "\t", "aa", "s")]
    found = duplicate_groups(documents(rows)).cache()
    assert answer(found) == brute(rows)
    kept = [(r.doc_id, r.text_sha256) for r in found.where("kept").collect()]
    assert len(kept) == 4 and all(r.keep_id == r.doc_id for r in found.where("kept").collect())
