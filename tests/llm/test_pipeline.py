import corpus_pipeline
from conftest import SAMPLES

from __spark_entry__ import oracle_sql, queries
from daybook.llm.mixing import mix
from daybook.llm.queries import ORACLE, QUERIES


def test_stages_hand_on_documents(spark, documents, odd_rows, prose):
    rows = odd_rows + [(100 + i, prose(i, 40 + i), "aa", "s1") for i in range(40)]
    rows += [(200, prose(3, 43) + " more", "aa", "s1"), (201, prose(4, 44).replace(" ", "\t"), "aa", "s1")]
    docs = documents(rows)
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SAMPLES).cache()
        assert docs.columns == corpus_pipeline.COLUMNS
        counts.append(docs.count())
        ids = [r.doc_id for r in docs.collect()]
        if len(counts) == 1:
            assert {2, 3, 4, 8}.isdisjoint(ids) and {1, 5, 6, 9, 100}.issubset(ids)
        if len(counts) == 2:
            assert ids.count(1) == 1 and 7 not in ids and {5, 6} & set(ids) != {5, 6} and 201 not in ids
            assert 104 in ids
        if len(counts) == 3:
            assert 200 not in ids and 103 in ids
            taken = {r.doc_id: (r.taken, r.size) for r in mix(docs).collect()}
        if len(counts) == 4:
            assert all(ids.count(i) == int(t / s + 0.5) for i, (t, s) in taken.items() if s)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SAMPLES)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_an_id_with_several_texts_decides_for_each(spark, documents, prose):
    """One near copy, one exact copy and one text of its own under one id, and under none."""
    near = prose(1, 60) + " more"
    rows = [(1, prose(1, 60), "aa", "s1"), (2, prose(2, 60), "aa", "s1")]
    for i in (5, None):
        rows += [(i, near, "aa", "s1"), (i, prose(2, 60).replace(" ", "\n"), "aa", "s1")]
        rows += [(i, prose(3 if i else 4, 50), "aa", "s1")]
    docs, stages = documents(rows), dict(corpus_pipeline.STAGES)
    for name in ("exact copies", "near copies"):
        docs = stages[name](spark, docs, SAMPLES).cache()
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == sorted(
        [(1, prose(1, 60)), (2, prose(2, 60)), (5, prose(3, 50)), (0, prose(4, 50))]
    )
    mixed = stages["mix"](spark, docs, SAMPLES).collect()
    taken = {r.text for r in mixed}
    assert taken <= {r.text for r in docs.collect()} and len(mixed) > len(taken) / 2


def test_empty_documents(spark, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SAMPLES)
    assert docs.count() == 0


def test_run_over_the_sample(spark):
    found = corpus_pipeline.run(spark, SAMPLES)
    assert found.count() > 100


def test_registered():
    assert set(QUERIES) < set(queries()) and "pipeline" in queries()
    assert set(ORACLE) < set(oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
