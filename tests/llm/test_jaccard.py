import random
import re

import numpy as np
import pytest

from daybook.llm.components import components
from daybook.llm.jaccard import Shingler, Similarity, _Join, _least_distance, _signature, near_duplicates


def grams(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= k:
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)] if words else [])


def brute(rows, s):
    sets = [(i, grams(t, s.words)) for i, t, *_ in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b:
                if s.of * len(a & b) >= s.part * len(a | b):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return sorted(((i, len(a), None if i is None else find(i)) for i, a in sets), key=str)


def answer(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(rng, text, share):
    words = text.split(" ")
    for _ in range(max(1, int(len(words) * share))):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("s", [Similarity(3, 90, 100), Similarity(5, 80, 100)])
def test_odd_rows(documents, odd_rows, s):
    rows = odd_rows + [(20, "One  TWO", "bb", "s"), (21, odd_rows[0][1].upper(), "bb", "s")]
    assert answer(near_duplicates(documents(rows), s)) == brute(rows, s)


def test_chains_and_a_large_group(documents, prose, monkeypatch):
    """Near copies of one text, chains of edits, and a passage that most texts share."""
    s, rng = Similarity(3, 90, 100), random.Random(2)
    passage, base = prose(500, 60), prose(501, 150)
    texts = [edited(rng, base, rng.choice([0.002, 0.01, 0.03])) for _ in range(90)]
    texts += [f"{prose(i, 60)} {passage} {prose(i + 900, 60)}" for i in range(70)]
    chain = prose(700, 200)
    for _ in range(25):
        chain = edited(rng, chain, 0.01)
        texts.append(chain)
    rng.shuffle(texts)
    rows = [(i, t, "aa", "s") for i, t in enumerate(texts)]
    assert answer(near_duplicates(documents(rows), s)) == brute(rows, s)
    # The same with other bounds, so that all rounds and orders are used.
    monkeypatch.setattr("daybook.llm.jaccard.COMMON", 3)
    monkeypatch.setattr("daybook.llm.jaccard.LONG", 10)
    assert answer(near_duplicates(documents(rows), s)) == brute(rows, s)


def test_rows_of_long_lists_are_joined_once(documents, prose, monkeypatch):
    """Steps on long lists read stored rows: neither they nor their components are joined again."""
    s, rng, seen = Similarity(3, 90, 100), random.Random(4), []
    stars = _Join._stars

    def plans(*frames):
        return [str(f._jdf.queryExecution().optimizedPlan()).count("Join ") for f in frames]

    def watched(self, lists, key, turn, *rest, **more):
        found = stars(self, lists, key, turn, *rest, **more)
        if turn:
            seen.append(plans(lists, found))
        return found

    monkeypatch.setattr(_Join, "_stars", watched)
    monkeypatch.setattr("daybook.llm.jaccard.COMMON", 3)
    monkeypatch.setattr("daybook.llm.jaccard.LONG", 10)
    base = prose(501, 150)
    rows = [(i, edited(rng, base, rng.choice([0.01, 0.05])), "aa", "s") for i in range(60)]
    assert answer(near_duplicates(documents(rows), s)) == brute(rows, s)
    assert seen == [[0, 1]]


def test_pairs_of_a_long_list_without_those_inside_its_largest_component(spark):
    rng, join = random.Random(5), _Join.__new__(_Join)
    join.similar = s = Similarity(5, 80, 100)
    sizes = {v: rng.randint(40, 60) for v in range(90)}
    # Before the labels every node stands alone; 0 to 59 have one component by now, list 3 no other.
    label = {v: 0 if v < 60 else v // 4 * 4 for v in range(80)}
    rows = [
        (key, v, sizes[v], rng.randint(0, 12), rng.random() < 0.3, v)
        for key in range(4) for v in range(60 if key == 3 else 90) if rng.random() < 0.7
    ]
    lists = spark.createDataFrame(rows, "key long, v long, n long, pos int, wide boolean, comp long")
    labels = spark.createDataFrame(sorted(label.items()), "v long, component long")
    rest = join.still_apart(lists, labels)
    assert {(r.key, r.bulk) for r in rest.select("key", "bulk").distinct().collect()} == {(k, 0) for k in range(3)}
    expected = set()
    for key, a, na, pa, wa, _ in rows:
        for other, b, nb, pb, wb, _ in rows:
            need = -(-s.part * (na + nb) // (s.part + s.of))
            apart = key == other and a < b and label.get(a, a) != label.get(b, b) and not (wa and wb)
            if apart and min(na, nb) * s.of >= max(na, nb) * s.part and min(na - pa, nb - pb) >= need:
                expected.add((a, b))
    found = [(min(r.a, r.b), max(r.a, r.b)) for r in join.pairs_beside_bulk(rest).collect()]
    assert sorted(found) == sorted(expected) and len(expected) > 100


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0


def test_shingles_do_not_depend_on_neighbours(prose):
    texts = [prose(i, n) for i, n in enumerate([0, 1, 2, 3, 50, 400, 4, 0])]
    together = list(Shingler(3).sets(texts))
    for text, found in zip(texts, together, strict=True):
        assert (found == next(Shingler(3).sets([text]))).all()
        assert len(found) == len(grams(text, 3))


def test_signatures_bound_the_distance():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 3000))
        a = rng.integers(-(2**63), 2**63, n)
        b = np.concatenate([a[: n * int(rng.integers(1, 10)) // 10], rng.integers(-(2**63), 2**63, n // 5)])
        if len(b):
            true = len(np.setxor1d(a, b))
            assert _least_distance(_signature(np.unique(a)), _signature(np.unique(b))) <= true


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(1000, 1050)] + [(7, 7)]
    found = dict(components(spark.createDataFrame(links, "u long, v long")).collect())
    assert found == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys([5, *range(1000, 1050)], 5)}
