"""Collocations by best-first branch and bound over growing phrases.

A phrase grows word by word. What is counted of a prefix bounds every phrase that
begins with it: no longer phrase occurs more often, and the part after a cut occurs
at least as often as the whole, so its score is at most scale * n / (f(first part) +
n) for the largest n that is still possible. The frontier holds the phrases that are
not grown yet; per language those with the highest bounds are grown first, all of a
wave in one pass over the texts. Growing a phrase counts its extensions on both
sides, which also settles whether a longer phrase replaces it. A language is
finished when nothing in the frontier could reach the score of its last place.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import BROADCAST_ROWS, discard, stored

UNKNOWN = "und"
# What ends a piece, what stands between words, capitals.
_TABLE = bytes.maketrans(
    b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"\n\n\n\n\n\n\n\n\n\n abcdefghijklmnopqrstuvwxyz",
)
_DOTS = _TABLE.replace(b"\n", b".")
# Different phrases that a task counts before it hands its counts on.
HELD = 200_000
# Phrases of a language grown in the first wave; each later wave takes more.
FIRST_WAVE, MORE = 8_000, 4
# Phrases of all languages grown in one wave, and their bytes: sent to every executor.
WAVE, WAVE_BYTES = 200_000, 64 << 20
COUNTS = "lang string, size int, phrase string, n long"
_CODES = "number int, size int, code long, last long, n long"
# Frequent words, and pairs of them, that are sent to every executor; more are counted by name.
VOCABULARY, PAIRS = 500_000, 2_000_000
# Words that a task numbers before it counts them.
HELD_WORDS = 2_000_000
_KEY = ["lang", "phrase"]


@dataclass(frozen=True)
class Rules:
    """What counts as a collocation.

    Phrases of two to four words that occur ``least`` times; ``scale`` * f / (l + r)
    of the weakest cut is the score; a phrase goes if a longer one has ``part`` of
    ``of`` of its occurrences; ``top`` are returned per language.
    """

    least: int = 30
    scale: int = 2_000_000
    part: int = 80
    of: int = 100
    top: int = 2_000


def pieces_of(text: str) -> list[list[bytes]]:
    """The words of every piece of a text, lower-cased in A-Z."""
    return [p.split() for p in text.encode("utf-8").translate(_TABLE).split(b"\n")]


class _Held:
    """Counts of one task, handed on whenever they grow beyond a bound."""

    def __init__(self) -> None:
        self.counts: dict[str, Counter] = {}
        self.size = 0

    def of(self, lang: str) -> Counter:
        return self.counts.setdefault(lang, Counter())

    def rows(self) -> Iterator[pa.RecordBatch]:
        for lang, counts in self.counts.items():
            if counts:
                words = isinstance(next(iter(counts)), bytes)
                phrases = [(p if words else b" ".join(p)).decode("utf-8") for p in counts]
                sizes = [1] * len(phrases) if words else map(len, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(phrases), pa.string()),
                        pa.array(sizes, pa.int32()),
                        pa.array(phrases, pa.string()),
                        pa.array(counts.values(), pa.int64()),
                    ],
                    names=["lang", "size", "phrase", "n"],
                )
        self.counts, self.size = {}, 0


def _counting(add):
    """A task that lets ``add(counts, lang, words)`` count every piece of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                langs, texts = (c.to_pylist() for c in part.columns)
                for lang, text in zip(langs, texts, strict=True):
                    counts = held.of(lang)
                    before = len(counts)
                    for words in pieces_of(text or ""):
                        add(counts, lang, words)
                    held.size += len(counts) - before
                    if held.size > HELD:
                        yield from held.rows()
        yield from held.rows()

    return run


def _counted(texts: DataFrame, add) -> DataFrame:
    return (
        texts.mapInArrow(_counting(add), COUNTS).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    )


def _add_words(counts: Counter, lang: str, words: list[bytes]) -> None:
    counts.update(words)


def _add_pairs(counts: Counter, lang: str, words: list[bytes]) -> None:
    counts.update(zip(words, words[1:]))


def _add_extensions(wave):
    """Count the phrases one word longer than those grown, at either side, and those asked for."""

    def add(counts: Counter, lang: str, words: list[bytes]) -> None:
        grown = wave.value.get(lang)
        if grown is None or len(words) < 3:
            return
        pairs, triples, asked = grown
        threes = list(zip(words, words[1:], words[2:]))
        if pairs:
            hit = [p in pairs for p in zip(words, words[1:])]
            for three, left, right in zip(threes, hit, hit[1:]):
                if left or right or three in asked:
                    counts[three] += 1
        elif asked:
            counts.update(three for three in threes if three in asked)
        if triples and len(words) > 3:
            hit = [three in triples for three in threes]
            if True in hit:
                for at in range(len(words) - 3):
                    if hit[at] or hit[at + 1]:
                        counts[tuple(words[at : at + 4])] += 1

    return add


class _Ids(dict):
    """Numbers of the frequent words of a language; other words, and ends of pieces, are -1."""

    def __missing__(self, word: bytes) -> int:
        return -1


def _vocabulary(words: DataFrame) -> list[tuple[str, _Ids]] | None:
    """The frequent words by language, numbered, or None if they are too many to send out."""
    count, size = words.agg(F.count(F.lit(1)), F.sum(F.octet_length("phrase"))).first()
    if count > VOCABULARY or (size or 0) > WAVE_BYTES:
        return None
    known: dict[str, _Ids] = {}
    for lang, word in words.select("lang", "phrase").toLocalIterator():
        ids = known.setdefault(lang, _Ids())
        ids[word.encode("utf-8")] = len(ids)
    return list(known.items())


def _within(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which codes are among the sorted ``wanted`` ones."""
    if not len(wanted):
        return np.zeros(len(codes), bool)
    at = np.searchsorted(wanted, codes)
    at[at == len(wanted)] = 0
    return wanted[at] == codes


def _pair_codes(ids: np.ndarray, base: int) -> np.ndarray:
    """A number for each two words that follow each other; -1 where one is unknown."""
    return np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * base + ids[1:], -1)


@dataclass
class _Wave:
    """Phrases to grow, and trigrams asked for, of one language, as sorted codes.

    Three words fit a 64-bit number; a fourth stands beside it. ``frequent`` has the
    codes of all frequent pairs, or is None where these are too many to send out:
    a phrase with a rarer pair inside need not be counted.
    """

    pairs: np.ndarray
    triples: np.ndarray
    asked: np.ndarray
    frequent: np.ndarray | None

    def counts(self, ids: np.ndarray, base: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(size, code, last word, count) of the extensions in a run of words."""
        two = _pair_codes(ids, base)
        known = two >= 0
        three = np.where(known[:-1] & known[1:], two[:-1] * base + ids[2:], -1)
        grown = _within(two, self.pairs)
        first = np.unique(np.concatenate([self.triples, self.asked]) // base)
        near = np.flatnonzero((three >= 0) & _within(two[:-1], first))
        triple, asked = np.zeros(len(three), bool), np.zeros(len(three), bool)
        triple[near] = _within(three[near], self.triples)
        asked[near] = _within(three[near], self.asked)

        at = np.flatnonzero((three >= 0) & (grown[:-1] | grown[1:] | asked))
        at = at[self._possible(two, at, 2)]
        codes, counts = np.unique(three[at], return_counts=True)
        yield 3, codes, np.full(len(codes), -1), counts
        if len(three) > 1 and triple.any():
            at = np.flatnonzero((three[:-1] >= 0) & (three[1:] >= 0) & (triple[:-1] | triple[1:]))
            at = at[self._possible(two, at, 3)]
            found = np.stack([three[at], ids[at + 3]], axis=1)
            codes, counts = np.unique(found, axis=0, return_counts=True)
            yield 4, codes[:, 0], codes[:, 1], counts

    def _possible(self, two: np.ndarray, at: np.ndarray, pairs: int) -> np.ndarray:
        possible = np.ones(len(at), bool)
        if self.frequent is not None:
            for k in range(pairs):
                possible &= _within(two[at + k], self.frequent)
        return possible


def _all_pairs(ids: np.ndarray, base: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    two = _pair_codes(ids, base)
    codes, counts = np.unique(two[two >= 0], return_counts=True)
    yield 2, codes, np.full(len(codes), -1), counts


def _numbering(sent):
    """The words of every text as numbers; unknown ones in a row are one -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = {lang: (at, ids) for at, (lang, ids) in enumerate(sent.value)}
        for batch in batches:
            for at in range(0, len(batch), 500):
                numbers, coded = [], []
                langs, texts = (c.to_pylist() for c in batch.slice(at, 500).columns)
                for lang, text in zip(langs, texts, strict=True):
                    if text and lang in languages:
                        number, known = languages[lang]
                        words = text.encode("utf-8").translate(_DOTS).replace(b".", b" . ").split()
                        ids = np.array([*map(known.__getitem__, words), -1], "<i4")
                        ids = ids[(ids >= 0) | (np.r_[-1, ids[:-1]] >= 0)]
                        if len(ids) > 2:
                            numbers.append(number)
                            coded.append(ids.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers, pa.int32()), pa.array(coded, pa.binary())],
                    names=["number", "ids"],
                )

    return run


def _counting_codes(sent):
    """A task that counts phrases of numbered texts, for the languages that ``sent`` has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases, waves = sent.value
        held: dict[int, list[bytes]] = {}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for number, texts in held.items():
                ids, base = np.frombuffer(b"".join(texts), "<i4").astype(np.int64), bases[number]
                found = _all_pairs(ids, base) if waves is None else waves[number].counts(ids, base)
                for length, codes, last, counts in found:
                    for at in range(0, len(codes), 50_000):
                        part = slice(at, at + 50_000)
                        rows = len(codes[part])
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(rows, number, np.int32)),
                                pa.array(np.full(rows, length, np.int32)),
                                pa.array(codes[part]), pa.array(last[part].astype(np.int64)),
                                pa.array(counts[part].astype(np.int64)),
                            ],
                            names=["number", "size", "code", "last", "n"],
                        )
            held.clear()

        for batch in batches:
            for number, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if waves is None or number in waves:
                    held.setdefault(number, []).append(ids)
                    size += len(ids) // 4
                if size > HELD_WORDS:
                    yield from counted()
                    size = 0
        yield from counted()

    return run


def _decoding(sent):
    """Phrases of the numbers that ``_counting_codes`` gave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [(lang, list(ids)) for lang, ids in sent.value]
        for batch in batches:
            langs, phrases = [], []
            for number, size, code, last in zip(*[c.to_pylist() for c in batch.columns[:4]], strict=True):
                lang, known = words[number]
                found = [known[last]] if size == 4 else []
                for _ in range(min(size, 3)):
                    code, word = divmod(code, len(known))
                    found.insert(0, known[word])
                langs.append(lang)
                phrases.append(b" ".join(found).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), batch.column(1), pa.array(phrases, pa.string()), batch.column(4)],
                names=["lang", "size", "phrase", "n"],
            )

    return run


class _Counter:
    """Counts phrases over the texts: as numbers where the vocabulary can be sent out."""

    def __init__(self, texts: DataFrame, words: DataFrame, least: int) -> None:
        self.texts, self.least = texts, least
        self.context = texts.sparkSession.sparkContext
        self.vocabulary = _vocabulary(words)
        self.frequent: dict[int, np.ndarray] | None = None
        if self.vocabulary is not None:
            self.numbers = {lang: at for at, (lang, _) in enumerate(self.vocabulary)}
            self.words = self.context.broadcast(self.vocabulary)
            # A few bytes a word; the passes that follow read this instead of the texts.
            numbered = texts.mapInArrow(_numbering(self.words), "number int, ids binary")
            self.numbered = stored(numbered)

    def _counted(self, waves) -> tuple[DataFrame, DataFrame]:
        sent = self.context.broadcast(([len(ids) for _, ids in self.vocabulary], waves))
        keys = ["number", "size", "code", "last"]
        codes = stored(
            self.numbered.mapInArrow(_counting_codes(sent), _CODES)
            .groupBy(*keys).agg(F.sum("n").alias("n")).where(F.col("n") >= self.least)
        )
        sent.destroy()
        return stored(codes.mapInArrow(_decoding(self.words), COUNTS), release=False), codes

    def pairs(self) -> DataFrame:
        if self.vocabulary is None:
            return stored(_counted(self.texts, _add_pairs).where(F.col("n") >= self.least))
        phrases, codes = self._counted(None)
        if codes.count() <= PAIRS:
            found = codes.select("number", "code").toPandas()
            self.frequent = {
                number: np.sort(part.to_numpy()) for number, part in found.groupby("number")["code"]
            }
        return phrases

    def extensions(self, wave: list) -> DataFrame:
        by_language = _by_language(wave)
        if self.vocabulary is None:
            sent = self.context.broadcast(by_language)
            counts = _counted(self.texts, _add_extensions(sent)).where(F.col("n") >= self.least)
            counts = stored(counts)
            sent.destroy()
            return counts
        known = dict(self.vocabulary)

        def codes(lang: str, phrases: set[tuple]) -> np.ndarray:
            base, found = len(known[lang]), []
            for phrase in phrases:
                code = 0
                for word in phrase:
                    code = code * base + known[lang][word]
                found.append(code)
            return np.sort(np.array(found, np.int64))

        waves = {}
        for lang, sets in by_language.items():
            number = self.numbers[lang]
            frequent = None if self.frequent is None else self.frequent[number]
            waves[number] = _Wave(*[codes(lang, s) for s in sets], frequent)
        return self._counted(waves)[0]

    def end(self) -> None:
        if self.vocabulary is not None:
            self.words.destroy()
            discard(self.numbered)


def _words(first: int, last: int) -> Column:
    """Words ``first`` to ``last`` of a phrase, counted from 1."""
    return F.array_join(F.slice(F.split("phrase", " "), first, last - first + 1), " ")


def _share(n: Column, other: Column, scale: int) -> Column:
    """floor(scale * n / other), exact also where the product needs more than 64 bits."""
    product = n.cast("decimal(20,0)") * F.lit(scale).cast("decimal(18,0)")
    return F.call_function("div", product, other.cast("decimal(20,0)"))


def _look_up(phrases: DataFrame, key: Column, table: DataFrame, out: str) -> DataFrame:
    """Add the count that ``table`` has for a part of the phrase; null where it has none."""
    right = table.select(
        F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("n").alias(out)
    )
    keyed = phrases.withColumn("_key", key)
    on = (F.col("lang") == F.col("_lang")) & (F.col("_key") == F.col("_phrase"))
    return keyed.join(right, on, "left").drop("_key", "_lang", "_phrase")


def _weakest(cuts: list[tuple[Column, Column]], rules: Rules) -> Column:
    """(score, k, l, r) of the cut with the lowest score, the first of equals."""
    scored = [
        F.struct(
            _share(F.col("n"), left + right, rules.scale).alias("score"), F.lit(k).alias("k"),
            left.alias("l"), right.alias("r"),
        )
        for k, (left, right) in enumerate(cuts, start=1)
    ]
    return F.array_min(F.array(*scored))


def _described(phrases: DataFrame, size: int, tables: dict[int, DataFrame], ends, rules: Rules) -> DataFrame:
    """Phrases of one size with score, bound of longer ones, and whether one may replace them.

    Where a trigram inside a phrase of four is not counted yet, the phrase's own
    count stands in, which makes the score a bound; ``missing`` says so.
    """
    found, cuts, missing = phrases, [], F.lit(False)
    for k in range(1, size):
        for side, a, b in (("l", 1, k), ("r", k + 1, size)):
            found = _look_up(found, _words(a, b), tables[b - a + 1], f"{side}{k}")
            missing = missing | F.col(f"{side}{k}").isNull()
        cuts.append((F.coalesce(f"l{k}", "n"), F.coalesce(f"r{k}", "n")))
    found = found.withColumns({"cut": _weakest(cuts, rules), "missing": missing})
    if size == 4:
        return found.select(
            *_KEY, "n", "cut.*", "missing", F.lit(None).cast("long").alias("bound"),
            F.lit(False).alias("unsure"),
            F.when(F.col("r1").isNull(), _words(2, 4)).alias("ask_last"),
            F.when(F.col("l3").isNull(), _words(1, 3)).alias("ask_first"),
        )
    ahead, behind = ends
    found = _look_up(found, _words(size, size), ahead, "ahead")
    found = _look_up(found, _words(1, 1), behind, "behind")
    # No longer phrase occurs more often than the last word goes on.
    reach = F.least("n", "ahead")
    bounds = [_share(reach, F.col(f"l{k}") + reach, rules.scale) for k in range(1, size)]
    often = [F.col(c) * rules.of >= F.col("n") * rules.part for c in ("ahead", "behind")]
    return found.select(
        *_KEY, "n", "cut.*", "missing",
        F.when(F.col("ahead").isNotNull(), F.least(*bounds) if size > 2 else bounds[0]).alias("bound"),
        (F.coalesce(often[0], F.lit(False)) | F.coalesce(often[1], F.lit(False))).alias("unsure"),
        F.lit(None).cast("string").alias("ask_last"), F.lit(None).cast("string").alias("ask_first"),
    )


def _state(nodes: DataFrame, size: int, longer: DataFrame | None, grown: DataFrame, rules: Rules) -> DataFrame:
    """Phrases of one size with what is settled about them so far."""
    flagged = nodes.join(
        grown.where(F.col("size") == size).select(*_KEY, F.lit(True).alias("grown")), _KEY, "left"
    ).withColumn("grown", F.coalesce("grown", F.lit(False)))
    if longer is None:
        flagged = flagged.withColumn("replaced", F.lit(False))
    else:
        inside = longer.select(
            "lang", "n", F.explode(F.array(_words(1, size), _words(2, size + 1))).alias("phrase")
        )
        most = inside.groupBy(*_KEY).agg(F.max("n").alias("most"))
        replaced = F.col("most") * rules.of >= F.col("n") * rules.part
        flagged = flagged.join(most, _KEY, "left").withColumn(
            "replaced", F.coalesce(replaced, F.lit(False))
        )
    open_ = ~F.col("replaced") & ((F.col("unsure") & ~F.col("grown")) | F.col("missing"))
    return flagged.select(
        *_KEY, F.lit(size).alias("size"), "n", "score", "l", "r", "bound", "grown",
        "replaced", open_.alias("open"), "ask_last", "ask_first",
    )


def _frontier(state: DataFrame) -> DataFrame:
    """(lang, size, phrase, asked, key) of what could still be counted; key bounds its scores."""
    growable = state.where(~F.col("grown") & (F.col("size") < 4)).select(
        "lang", "size", "phrase", F.lit(False).alias("asked"),
        F.greatest("bound", F.when(F.col("open"), F.col("score"))).alias("key"),
    )
    asked = state.where("open").select(
        "lang", F.lit(3).alias("size"), F.explode(F.array("ask_last", "ask_first")).alias("phrase"),
        F.lit(True).alias("asked"), F.col("score").alias("key"),
    )
    asked = asked.groupBy("lang", "size", "phrase", "asked").agg(F.max("key").alias("key"))
    return growable.unionByName(asked).where("key IS NOT NULL AND phrase IS NOT NULL")


def _best(frontier: DataFrame, last: DataFrame, take: int) -> list:
    """The next wave: per language the phrases of the highest bounds that still matter."""
    by_bound = Window.partitionBy("lang").orderBy(F.desc("key"), "phrase", "size", "asked")
    weight = F.sum(F.octet_length("phrase")).over(by_bound)
    return (
        frontier.join(last, "lang", "left")
        .where("last IS NULL OR key >= last")
        .withColumn("place", F.row_number().over(by_bound))
        .where(F.col("place") <= take)
        .withColumn("bytes", weight)
        .where((F.col("bytes") <= WAVE_BYTES // 16) | (F.col("place") == 1))
        .orderBy("place", "lang")
        .limit(WAVE)
        .select("lang", "size", "phrase", "asked")
        .collect()
    )


def _by_language(wave: list) -> dict[str, tuple[set, set, set]]:
    """Pairs and triples to grow and triples asked for, as tuples of words."""
    found: dict[str, tuple[set, set, set]] = {}
    for lang, size, phrase, asked in wave:
        sets = found.setdefault(lang, (set(), set(), set()))
        words = tuple(phrase.encode("utf-8").split(b" "))
        sets[2 if asked else size - 2].add(words)
    return found


def collocations(docs: DataFrame, rules: Rules = Rules(), first_wave: int = FIRST_WAVE) -> DataFrame:
    """The best collocations of every language.

    Takes ``text`` and ``lang``; other columns are ignored. A null text is empty and a
    null language ``und``. Rows that repeat count each time. Ties in score go to the
    more frequent phrase, then to the smaller by bytes. An empty table, or one without
    frequent phrases, gives no rows. Returns lang, rank, phrase, n_phrase, l, r (counts
    of the two parts at the weakest cut), n_words (of the language) and score.

    The texts are read once for words and once to number them; pairs and each wave read
    the numbers. Where frequent words are too many to send out, these passes read the
    texts and count by name. What is kept between are the phrases that occur ``least``
    times. All counts are exact.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    every_word = stored(_counted(texts, _add_words))
    totals = every_word.groupBy("lang").agg(F.sum("n").alias("n_words"))
    frequent = F.col("n") >= rules.least
    words = stored(every_word.where(frequent))
    counter = _Counter(texts, words, rules.least)
    pairs = counter.pairs()

    # How often each word goes on, and is come to, at most.
    ahead = pairs.groupBy("lang", _words(1, 1).alias("phrase")).agg(F.max("n").alias("n"))
    behind = pairs.groupBy("lang", _words(2, 2).alias("phrase")).agg(F.max("n").alias("n"))
    ends = stored(ahead, release=False), stored(behind, release=False)
    none = spark.createDataFrame([], COUNTS)
    tables = {1: words, 2: pairs, 3: none, 4: none}
    nodes2 = stored(_described(pairs, 2, tables, ends, rules))
    grown = spark.createDataFrame([], "lang string, size int, phrase string")

    take = first_wave
    while True:
        nodes3 = _described(tables[3], 3, tables, ends, rules)
        nodes4 = _described(tables[4], 4, tables, ends, rules)
        state = stored(
            _state(nodes2, 2, tables[3], grown, rules)
            .unionByName(_state(nodes3, 3, tables[4], grown, rules))
            .unionByName(_state(nodes4, 4, None, grown, rules)),
            release=False,
        )
        settled = state.where("NOT open AND NOT replaced")
        # Each task hands on its best ``top`` rows of a language only.
        place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("n"), "phrase")
        best = stored(
            settled.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= rules.top),
            release=False,
        )
        last = best.where(F.col("rank") == rules.top).select("lang", F.col("score").alias("last"))
        wave = _best(_frontier(state), last, take)
        if not wave:
            counter.end()
            break
        counts = counter.extensions(wave)
        for size in (3, 4):
            both = tables[size].unionByName(counts.where(F.col("size") == size))
            tables[size] = stored(both.dropDuplicates(_KEY), release=False)
        now = [(w.lang, w.size, w.phrase) for w in wave if not w.asked]
        grown = stored(grown.unionByName(spark.createDataFrame(now, grown.schema)), release=False)
        take *= MORE

    return best.join(F.broadcast(totals) if _few(totals) else totals, "lang").select(
        "lang", "rank", "phrase", F.col("n").alias("n_phrase"), "l", "r", "n_words", "score"
    )


def _few(rows: DataFrame) -> bool:
    return rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
