import zlib
from collections import defaultdict

from daybook.llm.sharding import assign_shards


def check(rows, found, shards=16):
    assert sorted((str(r.doc_id), r.size) for r in found) == sorted(
        (str(i), len((t or "").encode()) + 1) for i, t, *_ in rows
    )
    crcs = {zlib.crc32((t or "").encode()) for _, t, *_ in rows}
    slots, sums = defaultdict(list), defaultdict(int)
    for r in found:
        assert 0 <= r.shard < shards and r.text_crc32 in crcs
        slots[r.shard].append(r.slot)
        sums[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sums


def test_odd_rows(documents, odd_rows):
    check(odd_rows, assign_shards(documents(odd_rows)).collect())


def test_near_equal_bytes_and_copies_together(documents, prose):
    texts = [prose(i, 10 + 13 * i % 90) for i in range(1500)]
    rows = [(i, texts[i % 1200], "aa", f"s{i % 5}") for i in range(3000)]
    found = assign_shards(documents(rows)).collect()
    sums = check(rows, found)
    mean = sum(sums.values()) / 16
    assert all(abs(s - mean) < 0.05 * mean for s in sums.values())
    where = defaultdict(set)
    for r in found:
        where[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_a_third_of_all_rows_is_one_text(documents, prose):
    rows = [(i, "copy " * 12 if i % 3 == 0 else prose(i, 12), "aa", "s") for i in range(2400)]
    sums = check(rows, assign_shards(documents(rows)).collect())
    mean = sum(sums.values()) / 16
    assert len(sums) == 16 and all(abs(s - mean) < 0.06 * mean for s in sums.values())


def test_other_numbers_of_shards(documents, prose):
    rows = [(i, prose(i, 20), "aa", "s") for i in range(700)]
    sums = check(rows, assign_shards(documents(rows), 7).collect(), 7)
    assert len(sums) == 7 and max(sums.values()) < 1.1 * min(sums.values())


def test_empty_table(documents):
    assert assign_shards(documents([])).count() == 0


def test_ids_at_both_ends_of_long(documents, prose):
    ids = [-(2**63), 2**63 - 1, -8 * 10**18, 8 * 10**18, 0, None]
    rows = [(ids[i % 6] if i < 12 else (i * 7919**5) % 2**64 - 2**63, prose(i, 20), "aa", "s") for i in range(600)]
    sums = check(rows, assign_shards(documents(rows)).collect())
    assert len(sums) == 16 and max(sums.values()) < 1.2 * min(sums.values())


def test_rows_without_an_id_and_one_text_are_dealt_out(documents, prose):
    """Two fifths of the rows are equal and have no id: they fill several shards, and many ranges."""
    rows = [(None, "copy " * 12, "aa", "s")] * 800 + [(i, prose(i, 12), "aa", "s") for i in range(1200)]
    found = assign_shards(documents(rows)).collect()
    sums = check(rows, found)
    assert len(sums) == 16 and max(sums.values()) < 1.15 * min(sums.values())
    assert len({r.shard for r in found if r.doc_id is None}) > 4
