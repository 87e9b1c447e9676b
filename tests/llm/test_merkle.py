import hashlib
import zlib

from pyspark.sql import functions as F

from daybook.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source):
    fields = [doc_id, source, lang, None if text is None else len(text), text]
    return H(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def climb(leaves, fanout):
    """(root, proof of every leaf) of one tree, level by level."""
    nodes, proofs, at = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(nodes) > 1:
        for i, proof in enumerate(proofs):
            first, place = at[i] - at[i] % fanout, at[i] % fanout
            run = nodes[first : first + fanout]
            proof.append((place, run[:place] + run[place + 1 :]))
            at[i] //= fanout
        nodes = [H(*nodes[a : a + fanout]) for a in range(0, len(nodes), fanout)]
    return nodes[0], proofs


def expected(rows, fanout):
    """(doc_id, leaf) -> sorted (subroot, root, proof), by building the trees at once."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = [(r[0], leaf_of(*r)) for r in rows if r[2] == lang]
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = mine, *climb([leaf for _, leaf in mine], fanout)
    root, tops = climb([trees[lang][1] for lang in langs], fanout)
    found = []
    for lang, top in zip(langs, tops):
        mine, subroot, proofs = trees[lang]
        found += [(i, leaf, subroot, root, proof + top) for (i, leaf), proof in zip(mine, proofs)]
    return sorted(map(repr, found))


def rows_of(proven):
    return sorted(
        repr((r.doc_id, r.leaf, r.subroot, r.root, [(s.place, s.siblings) for s in r.proof]))
        for r in proven.collect()
    )


def test_odd_rows(documents, odd_rows):
    rows = [*odd_rows, (10, "é ü", "zz", "ß"), (11, "x", "", "")]
    assert rows_of(merkle.manifest(documents(rows))) == expected(rows, 8)


def test_ragged_trees_of_many_blocks(documents, monkeypatch):
    """Blocks of one level, so that a few dozen leaves exchange over several rounds."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(merkle, "SORTED_ROWS", 31)
    sizes = [1, 2, 3, 4, 5, 8, 9, 10, 15, 16, 17, 27, 40]
    rows = [(3 * i % 101, f"text {i}", f"l{n}", "s") for n in sizes for i in range(n)]
    assert rows_of(merkle.manifest(documents(rows), fanout=2)) == expected(rows, 2)


def test_copies_of_one_row_and_carried_columns(documents, monkeypatch):
    monkeypatch.setattr(merkle, "SORTED_ROWS", 10)
    rows = [(7, "same", "aa", "s")] * 100 + [(8, "other", None, None)]
    proven = merkle.manifest(documents(rows).withColumn("mark", F.upper("text")), carry=["mark"])
    assert rows_of(proven) == expected(rows, 8)
    assert {(r.doc_id, r.mark) for r in proven.collect()} == {(7, "SAME"), (8, "OTHER")}


def test_empty_table(documents):
    assert merkle.manifest(documents([])).count() == 0


def test_folding_finds_tampering(documents):
    rows = [(i, f"Text {i}", "aa" if i % 3 else "bb", "s") for i in range(30)]
    proven = merkle.manifest(documents(rows))
    wrong = F.when(F.col("doc_id") % 5 == 0, F.sha2("leaf", 256)).otherwise(F.col("leaf"))
    found = proven.select(
        "doc_id", (merkle.folded(wrong, F.col("proof")) == F.col("root")).alias("same"),
        merkle.proof_digest(F.col("proof")).alias("digest"), "proof",
    ).collect()
    assert all(r.same == (r.doc_id % 5 != 0) for r in found)
    assert all(r.digest == H(*[s for step in r.proof for s in step.siblings]) for r in found)


def test_remainder_is_that_of_the_decimal_id(spark):
    from daybook.llm.sampling import remainder

    ids = [0, 1, -5, 2**63 - 1, -(2**63), None]
    found = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", remainder(3).alias("r"))
    want = {i: None if i is None else zlib.crc32(str(i).encode()) % 3 for i in ids}
    assert {r.doc_id: r.r for r in found.collect()} == want


def test_levels():
    assert [merkle.levels_above(n, 8) for n in (0, 1, 2, 8, 9, 64, 65)] == [0, 0, 1, 1, 2, 2, 3]
