import random
import re
from collections import Counter, defaultdict

import pytest

from daybook.llm import phrases
from daybook.llm.phrases import Rules, collocations


def brute_force(rows, rules):
    """All counts, then scores, replacements and ranks, straight from the definition."""
    counts = defaultdict(Counter)
    for _, text, lang, _ in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            for size in (1, 2, 3, 4):
                for at in range(len(words) - size + 1):
                    counts[lang or "und"][words[at : at + size]] += 1
    found = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        frequent = {p: c for p, c in f.items() if len(p) > 1 and c >= rules.least}
        most = Counter()
        for q, c in frequent.items():
            for size in range(2, len(q)):
                for at in range(len(q) - size + 1):
                    most[q[at : at + size]] = max(most[q[at : at + size]], c)
        kept = []
        for p, a in frequent.items():
            if rules.of * most[p] >= rules.part * a:
                continue
            cuts = [(rules.scale * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        kept.sort()
        for rank, (score, a, phrase, left, right) in enumerate(kept[: rules.top], start=1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(found)


def rows_of(found):
    return sorted(
        (r.lang, r.rank, r.phrase, r.n_phrase, r.l, r.r, r.n_words, r.score) for r in found.collect()
    )


def chatter(seed, words, texts, langs=("aa", "bb", None)):
    """Texts of fixed phrases and single words, so that many phrases of all sizes are frequent."""
    rng = random.Random(seed)
    fixed = [" ".join(rng.choices(words, k=rng.choice((2, 3, 4, 5)))) for _ in range(25)]
    rows = []
    for i in range(texts):
        parts = [rng.choice(fixed) if rng.random() < 0.6 else rng.choice(words) for _ in range(40)]
        ends = [rng.choice((" ", " ", " ", "\t", ", ", ". ", "\n", "; x! ")) for _ in parts]
        rows.append((i, "".join(p + e for p, e in zip(parts, ends)), rng.choice(langs), "s"))
    return rows


WORDS = ["the", "The", "of", "new", "york", "é", "É", "stock-1", "中文", "a", "b", "c", "d", "e", "f", "g"]


def test_same_as_brute_force(documents):
    rows, rules = chatter(1, WORDS, 60), Rules(least=5, top=2000)
    want = brute_force(rows, rules)
    assert len(want) > 100 and {len(r[2].split()) for r in want} == {2, 3, 4}
    assert rows_of(collocations(documents(rows), rules)) == want


@pytest.mark.parametrize("top, first", [(1, 5), (20, 40)])
def test_stops_at_the_last_place_with_ties(documents, top, first):
    """Few places and small waves: languages end with most of the frontier never grown."""
    rows, rules = chatter(5, WORDS, 60), Rules(least=4, top=top)
    assert rows_of(collocations(documents(rows), rules, first_wave=first)) == brute_force(rows, rules)


def test_frontier_is_not_grown_further_than_needed(documents, monkeypatch):
    waves, by_language = [], phrases._by_language
    monkeypatch.setattr(phrases, "_by_language", lambda wave: waves.append(wave) or by_language(wave))
    rows = [(i, "left right. " * 3 + "of a b. of c d. of e f. of g h", "aa", "s") for i in range(40)]
    found = collocations(documents(rows), Rules(least=30, top=1))
    assert [(r.phrase, r.score) for r in found.collect()] == [("left right", 1_000_000)]
    grown = {w.phrase for wave in waves for w in wave}
    assert "of a" not in grown and "left right" not in grown


def test_without_a_vocabulary_and_with_counts_handed_on(documents, monkeypatch):
    monkeypatch.setattr(phrases, "VOCABULARY", 3)
    monkeypatch.setattr(phrases, "HELD", 1)
    rows, rules = chatter(3, WORDS, 40), Rules(least=5, top=50)
    assert rows_of(collocations(documents(rows), rules)) == brute_force(rows, rules)


def test_numbers_handed_on_in_small_parts(documents, monkeypatch):
    monkeypatch.setattr(phrases, "HELD_WORDS", 50)
    monkeypatch.setattr(phrases, "PAIRS", 3)
    rows, rules = chatter(4, WORDS, 40), Rules(least=5, top=50)
    assert rows_of(collocations(documents(rows), rules)) == brute_force(rows, rules)


def test_odd_rows(documents, odd_rows):
    rows, rules = odd_rows * 3, Rules(least=3, top=30)
    assert rows_of(collocations(documents(rows), rules)) == brute_force(rows, rules)


def test_empty_table_and_rare_phrases(documents):
    assert collocations(documents([])).count() == 0
    assert collocations(documents([(1, "one two three four five", "aa", "s")])).count() == 0


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(9 * 10**17, 10**18)], "n long, m long")
    share = phrases._share(F.col("n"), F.col("m"), 2_000_000)
    assert row.select(share.alias("x")).first().x == 1_800_000
