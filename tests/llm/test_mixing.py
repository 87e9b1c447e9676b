import pytest

from daybook.llm.mixing import mix, source_targets


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    full, budget = {}, share * sum(sizes.values())
    while True:
        free = [n for n in names if n not in full]
        rest = budget - sum(full.values())
        total = sum(weight[n] for n in free)
        over = [n for n in free if rest * weight[n] / total > limit * sizes[n]]
        if not over:
            return {**full, **{n: rest * weight[n] / total for n in free}}
        full |= {n: limit * sizes[n] for n in over}


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 10, "b": 1000, "c": 3, None: 500, "B": 0},
        {"a": 10_000, **{f"s{i}": 7 * i for i in range(30)}},
        {None: 5},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in source_targets(df).collect()}
    assert found == pytest.approx(brute_targets(sizes))


def test_targets_where_a_null_source_ties(spark):
    sizes = {"a": 100, "b": 100, "c": 100, None: 100}
    for given in (sizes, {"a": 100, None: 40, "b": 1, "c": 1}, {"a": 50, "b": 20, "c": 10, None: 50}):
        df = spark.createDataFrame(list(given.items()), "source string, source_size long")
        found = {r.source: r.target for r in source_targets(df).collect()}
        assert found == pytest.approx(brute_targets(given))
        assert sum(found.values()) == pytest.approx(1.5 * sum(given.values()))


def test_odd_rows(documents, odd_rows):
    rows = mix(documents(odd_rows)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_rows)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and (r.position is None) == (r.taken == 0)


def test_every_source_meets_its_target_and_reruns_agree(documents, prose):
    rows = [(i, prose(i, 5 + i % 60), "aa", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(900)]
    first, again = (mix(documents(rows)).collect() for _ in range(2))
    assert sorted(map(str, first)) == sorted(map(str, again))
    by = {}
    for r in first:
        taken, target = by.get(r.source, (0, r.target))
        by[r.source] = (taken + r.taken, target)
    assert all(taken == int(target) for taken, target in by.values())
    # The mix interleaves: half-way through, every source has sent about half.
    total = sum(r.taken for r in first)
    for source, (taken, _) in by.items():
        early = sum(r.taken for r in first if r.source == source and r.position is not None and r.position < total / 2 and r.taken <= r.size)
        assert early <= 0.75 * taken + 60


def test_empty_table(documents):
    assert mix(documents([])).count() == 0
