"""N-gram Jaccard join by grouped prefixes.

A document is the set of its word n-grams, as 64-bit hashes in one global order:
grams that many documents put forward come last, the others in order of their
hash. Two sets that are similar enough share a gram among the first few of
either, the prefix. Documents with the same size and the same prefix form one
group, so that near copies enter the join once. Groups that share a prefix gram
and pass the size and position filters are candidates; they are expanded to
their members, pairs are thinned out by small signatures whose distance never
exceeds that of the sets, and what is left is verified on the whole sets.

Equal sets are one node from the start. Links are gathered as components, and
candidates inside one component need no further look: a first round compares
every member of a group or list with its hub only, later ones just the pairs that
are still apart. All pairs inside a large group are never formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import discard, releasing, small_side, stored
from daybook.llm.components import components

# Documents in whose prefix a gram may stand before it is moved to the end.
COMMON = 50
# Lists of more nodes than this try a second hub before their pairs that are still
# apart are formed; lists of grams that are not common are shorter.
LONG = 2 * COMMON
# Bytes of text that are hashed together.
SLICE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Similarity:
    """Word n-grams and the least Jaccard similarity, as a fraction, of a link."""

    words: int = 5
    part: int = 80
    of: int = 100

    def prefix(self, n: int) -> int:
        return n + (-self.part * n // self.of) + 1 if n else 0

    def reach(self, n: int) -> int:
        """Grams put forward at first: the prefix and room for common grams in it."""
        p = self.prefix(n)
        return min(n, p + p // 2 + 4)

    def linked(self, shared: Column, a: Column, b: Column) -> Column:
        return shared * self.of >= (a + b - shared) * self.part

    def fits(self, a: Column, b: Column) -> Column:
        """Sizes that a link allows."""
        return F.least(a, b) * self.of >= F.greatest(a, b) * self.part

    def overlap(self, a: Column, b: Column) -> Column:
        return F.ceil((a + b) * self.part / F.lit(self.part + self.of))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted distinct n-gram hashes of texts."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.letters = _mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
        self.powers = np.ones(1, np.uint64)

    def _word_hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word."""
        inside = ~_SPACE[data]
        edge = np.flatnonzero(np.diff(np.r_[False, inside, False]))
        starts, ends = edge[::2], edge[1::2]
        if not len(starts):
            return starts, np.empty(0, np.uint64)
        lengths = ends - starts
        if (longest := int(lengths.max())) > len(self.powers):
            factors = np.full(2 * longest, np.uint64(0xD6E8FEB86659FD93))
            factors[0] = 1
            self.powers = np.multiply.accumulate(factors)
        offset = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        terms = self.letters[_LOWER[data[inside]]] * self.powers[offset]
        first = np.cumsum(lengths) - lengths
        return starts, _mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64))

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        at = 0
        while at < len(texts):
            part, size = [], 0
            while at < len(texts) and (not part or size < SLICE):
                part.append((texts[at] or "").encode("utf-8", "replace"))
                size += len(part[-1]) + 1
                at += 1
            data = np.frombuffer(b" ".join(part), np.uint8)
            starts, hashes = self._word_hashes(data)
            bounds = np.cumsum([len(p) + 1 for p in part])
            cut = np.r_[0, np.searchsorted(starts, bounds)]
            grams, k = self._grams(hashes), self.words
            for a, b in zip(cut, cut[1:], strict=False):
                if b - a >= k:
                    yield np.unique(grams[a : b - k + 1].view(np.int64))
                elif b > a:
                    whole = np.full(1, b - a, np.uint64)
                    for h in hashes[a:b]:
                        whole = _mix(whole * _BASE + h)
                    yield whole.view(np.int64)
                else:
                    yield np.empty(0, np.int64)

    def _grams(self, hashes: np.ndarray) -> np.ndarray:
        n = len(hashes) - self.words + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        gram = np.zeros(n, np.uint64)
        for i in range(self.words):
            gram = _mix(gram * _BASE + hashes[i : i + n])
        return gram


def _signature(grams: np.ndarray) -> bytes:
    """Counts of the grams in buckets, about a byte for every four to eight of them."""
    bits = max(4, int(len(grams)).bit_length() - 3)
    at = (grams.view(np.uint64) * _BASE) >> np.uint64(64 - bits)
    return np.minimum(np.bincount(at.astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _least_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the number of grams that only one of two sets has."""
    x, y = np.frombuffer(a, np.uint8).astype(np.int32), np.frombuffer(b, np.uint8).astype(np.int32)
    if len(x) != len(y):
        if max(x.max(), y.max()) >= 255:
            return 0
        if len(x) < len(y):
            x, y = y, x
        x = x.reshape(len(y), -1).sum(axis=1)
    return int(np.abs(x - y).sum())


_PRINTS = "doc_id long, n long, f1 long, f2 long, reach array<long>, sig binary"


def _lists(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    values = np.concatenate([*sets, np.empty(0, np.int64)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _prints(similar: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(similar.words)
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                n, f1, f2, reach, sig = [], [], [], [], []
                for grams in shingler.sets(batch.column(1).to_pylist()):
                    h = grams.view(np.uint64)
                    n.append(len(grams))
                    f1.append(int(_mix(h + np.uint64(1)).sum().view(np.int64)) if len(grams) else 0)
                    f2.append(int(_mix(h * _BASE).sum().view(np.int64)) if len(grams) else 0)
                    reach.append(grams[: similar.reach(len(grams))])
                    sig.append(_signature(grams) if len(grams) else b"")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                        pa.array(f2, pa.int64()), _lists(reach), pa.array(sig, pa.binary()),
                    ],
                    names=["doc_id", "n", "f1", "f2", "reach", "sig"],
                )

    return run


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                sets = list(shingler.sets(batch.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(sets)], names=["v", "grams"])

    return run


def _keep(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is among the stored ``ids``."""
    side = small_side(ids)
    return docs.join(side, docs.doc_id == side.v, "left_semi")


def _near(similar: Similarity):
    """Pairs that the signatures do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, sa, sb in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                shared = -(-similar.part * (na + nb) // (similar.part + similar.of))
                keep.append(_least_distance(sa, sb) <= na + nb - 2 * shared)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep))

    return run


def _prefixes(
    docs: DataFrame, nodes: DataFrame, similar: Similarity
) -> tuple[DataFrame, list[DataFrame]]:
    """(space, v, n, prefix, wide) of every node, under one order of grams per space.

    Returns the stored frames that this reads as well, to be removed once it is written.

    Space 0 has all nodes. A gram is common if more than COMMON nodes put it
    forward; that is a property of the gram, so every node orders it alike. Nodes
    whose reach has too few other grams look all their grams up, and are called
    wide. Space 1 has the wide nodes alone, ordered by how many of them have a gram:
    what sets a node of a large group of near copies apart then comes first. Pairs
    of wide nodes are looked for there only.
    """
    offered = nodes.select("v", F.explode("reach").alias("gram"))
    common = stored(offered.groupBy("gram").count().where(F.col("count") > COMMON).select("gram"))
    side = small_side(common)

    def ordered(sets: DataFrame, grams: str) -> DataFrame:
        hits = (
            sets.select("v", F.explode(grams).alias("gram")).join(side, "gram")
            .groupBy("v").agg(F.sort_array(F.collect_set("gram")).alias("common"))
        )
        known = sets.join(hits, "v", "left")
        none = F.array().cast("array<bigint>")
        return known.withColumn("common", F.coalesce("common", none)).withColumn(
            "rare", F.array_except(grams, "common")
        )

    size = F.floor(F.col("n") + F.floor(-F.col("n") * similar.part / similar.of) + 1)
    first = stored(
        ordered(nodes.select("v", "n", "reach"), "reach")
        .withColumn("p", size.cast("int"))
        .withColumn("wide", (F.size("rare") < F.col("p")) & (F.size("reach") < F.col("n")))
        .withColumn("prefix", F.slice(F.concat("rare", "common"), F.lit(1), F.col("p")))
        .select("v", "n", "p", "prefix", "wide")
    )
    wide = first.where("wide").select("v", "n", "p")
    whole = _keep(docs, stored(wide.select("v"))).mapInArrow(
        releasing(_full_sets(similar.words)), "v long, grams array<long>"
    )
    whole = stored(whole.join(wide, "v").where(F.size("grams") == F.col("n")))
    by_hash = ordered(whole, "grams").withColumn(
        "prefix", F.slice(F.concat("rare", "common"), F.lit(1), F.col("p"))
    )
    grams = whole.select("v", "n", "p", F.explode("grams").alias("gram"))
    frequency = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    by_frequency = (
        grams.join(frequency, "gram")
        .groupBy("v", "n", "p")
        .agg(F.sort_array(F.collect_set(F.struct("df", "gram"))).alias("grams"))
        .withColumn("prefix", F.slice(F.col("grams.gram"), F.lit(1), F.col("p")))
    )
    columns = ["v", "n", "prefix", "wide"]
    prefixes = (
        first.where("not wide").select(F.lit(0).alias("space"), *columns)
        .unionByName(by_hash.select(F.lit(0).alias("space"), "v", "n", "prefix", F.lit(True).alias("wide")))
        .unionByName(by_frequency.select(F.lit(1).alias("space"), "v", "n", "prefix", F.lit(True).alias("wide")))
    )
    return prefixes, [first, whole, common]


class _Join:
    """Candidates of the grouped prefix join and the links found among them so far."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, similar: Similarity) -> None:
        self.docs, self.nodes, self.similar = docs, nodes, similar
        prefixes, read = _prefixes(docs, nodes, similar)
        prefixes = stored(prefixes)
        for frame in read:
            discard(frame)
        key = F.xxhash64("space", "n", "wide", "prefix")
        self.members = stored(prefixes.select("v", "n", key.alias("g")).distinct())
        groups = prefixes.groupBy("space", "n", "wide", "prefix").agg(F.min("v").alias("leader"))
        groups = groups.withColumn("g", key)
        entries = groups.select(
            "g", "leader", "n", (F.col("wide") & (F.col("space") == 0)).alias("wide"),
            F.posexplode("prefix").alias("pos", "gram"), "space",
        ).withColumn("gram", F.xxhash64("space", "gram"))
        # A gram that one group alone has in its prefix leads nowhere.
        shared = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("gram")
        self.entries = stored(entries.drop("space").join(shared, "gram"))
        self.groups = stored(groups.select("g", "leader", "n"))
        discard(prefixes)
        self.links = self.checked = None

    def _labels(self) -> DataFrame:
        """(v, comp) of the nodes that are linked already; the others stand alone."""
        return components(self.links.select(F.col("a").alias("u"), F.col("b").alias("v"))) if self.links is not None else None

    def _allowed(self) -> Column:
        need = self.similar.overlap(F.col("na"), F.col("nb"))
        room = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
        elsewhere = F.col("wa") & F.col("wb")
        return self.similar.fits(F.col("na"), F.col("nb")) & (room >= need) & ~elsewhere

    def first_round(self) -> DataFrame:
        """Every node beside the leader of its group, and every leader beside the hub of its lists."""
        inside = self.members.join(self.groups.select("g", "leader"), "g").where("v <> leader")
        inside = inside.select(F.col("leader").alias("a"), F.col("v").alias("b"))
        return inside.unionByName(self._stars(self.entries.withColumnRenamed("leader", "v"), "gram", 0)).distinct()

    def _stars(self, lists: DataFrame, key: str, turn: int, differ: str = "v") -> DataFrame:
        """Every node of a list beside its hub, where ``differ`` does; one hub for each turn."""
        # Few rarer grams before this one: the node that has least of its own, and so
        # the one most likely to link with the others of a group of near copies.
        least = F.col("pos") if turn == 0 else F.lit(0)
        hub = F.struct(
            least.alias("own"), F.xxhash64("v", F.lit(turn)).alias("h"),
            *map(F.col, dict.fromkeys(["v", "n", "pos", "wide", differ])),
        )
        hubs = lists.groupBy(key).agg(F.min(hub).alias("hub"))
        return (
            lists.join(hubs, key).where(F.col(f"hub.{differ}") != F.col(differ))
            .select(
                F.col("hub.v").alias("a"), F.col("hub.n").alias("na"), F.col("hub.pos").alias("pa"),
                F.col("v").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"),
                F.col("hub.wide").alias("wa"), F.col("wide").alias("wb"),
            )
            .where(self._allowed())
            .select("a", "b")
        )

    def check(self, pairs: DataFrame, one_each: bool) -> None:
        """Verify pairs (of each b only the first, if asked) and add their links."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        sides = self.nodes.select("v", "n", "sig")
        left = sides.select(F.col("v").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
        right = sides.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
        near = (
            pairs.join(left, "a").join(right, "b")
            .select("a", "b", "na", "nb", "sa", "sb")
            .mapInArrow(releasing(_near(self.similar)), "a long, b long")
            .distinct()
        )
        if one_each:
            near = near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        near = stored(near)
        active = stored(near.select(F.col("a").alias("v")).unionByName(near.select(F.col("b").alias("v"))).distinct())
        sets = _keep(self.docs, active).mapInArrow(
            releasing(_full_sets(self.similar.words)), "v long, grams array<long>"
        )
        shared = F.size(F.array_intersect("ga", "gb"))
        done = stored(
            near.join(sets.select(F.col("v").alias("b"), F.col("grams").alias("gb")), "b")
            .join(sets.select(F.col("v").alias("a"), F.col("grams").alias("ga")), "a")
            .withColumn("shared", shared.cast("long"))
            .select("a", "b", self.similar.linked(F.col("shared"), F.size("ga"), F.size("gb")).alias("linked"))
        )
        found = done.where("linked").select("a", "b")
        self.links = found if self.links is None else self.links.unionByName(found)
        seen = done.select("a", "b")
        self.checked = seen if self.checked is None else self.checked.unionByName(seen)

    def apart(self, labels: DataFrame) -> DataFrame:
        """Lists and groups that still hold nodes of different components, expanded to nodes.

        A list whose groups all lie in one component is settled and left out.
        """
        members = self.members.join(labels, "v", "left").withColumn("comp", F.coalesce("component", "v"))
        members = stored(members.select("g", "v", "n", "comp"))
        spread = stored(members.groupBy("g").agg(F.min("comp").alias("low"), F.max("comp").alias("high")))
        open_lists = (
            self.entries.join(spread, "g").groupBy("gram")
            .agg(F.min("low").alias("low"), F.max("high").alias("high"))
            .where("low < high").select("gram")
        )
        in_lists = (
            self.entries.join(open_lists, "gram").select("g", "pos", "wide", F.col("gram").alias("key"))
            .join(members, "g").select("key", "v", "n", "pos", "wide", "comp")
        )
        in_groups = (
            members.join(spread.where("low < high").select("g"), "g")
            .select(F.col("g").alias("key"), "v", "n", F.lit(0).alias("pos"), F.lit(False).alias("wide"), "comp")
        )
        return stored(in_lists.unionByName(in_groups))

    def all_pairs(self, lists: DataFrame) -> DataFrame:
        """Pairs of different components that share a list and may be similar enough."""

        def side(name: str) -> DataFrame:
            return lists.select(
                "key", F.col("v").alias(name), F.col("n").alias(f"n{name}"),
                F.col("pos").alias(f"p{name}"), F.col("comp").alias(f"c{name}"),
                F.col("wide").alias(f"w{name}"),
            )

        joined = side("a").join(side("b"), "key").where("a < b and ca <> cb")
        return joined.where(self._allowed()).select("a", "b").distinct()

    def still_apart(self, lists: DataFrame, labels: DataFrame) -> DataFrame:
        """Lists that hold nodes of different components by now, with the largest one as ``bulk``."""
        now = lists.drop("comp").join(labels, "v", "left").withColumn("comp", F.coalesce("component", "v"))
        now = stored(now.drop("component"))
        shares = now.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("rows"))
        largest = shares.groupBy("key").agg(
            F.max(F.struct("rows", "comp")).alias("most"), F.min("comp").alias("low"), F.max("comp").alias("high")
        )
        bulk = largest.where("low < high").select("key", F.col("most.comp").alias("bulk"))
        marked = stored(now.join(bulk, "key"))
        discard(now)
        return marked

    def pairs_beside_bulk(self, lists: DataFrame) -> DataFrame:
        """The same pairs as ``all_pairs``, for long lists: nodes of the bulk do not meet each other.

        Only the nodes outside it are looked up in the list, so a large component with a
        few nodes beside it costs as many steps as it has nodes, for each of those few.
        """
        names = {"v": "", "n": "n", "pos": "p", "comp": "c", "wide": "w"}

        def side(name: str) -> list[Column]:
            return [F.col(c).alias(short + name) for c, short in names.items()]

        beside = lists.where("comp <> bulk").select("key", *side("a"))
        joined = beside.join(lists.select("key", "bulk", *side("b")), "key")
        joined = joined.where("ca <> cb and (cb = bulk or a < b)")
        return joined.where(self._allowed()).select("a", "b").distinct()

    def run(self) -> DataFrame:
        """(v, component) of all linked nodes."""
        self.check(self.first_round(), one_each=True)
        lists = self.apart(stored(self._labels()))
        sizes = stored(lists.groupBy("key").count().where(F.col("count") > LONG).select("key"))
        if sizes.isEmpty():
            self.check_new(self.all_pairs(lists))
            return stored(self._labels())
        keys = small_side(sizes)
        # Later steps read the rows of long lists several times: they are picked once.
        long = stored(lists.join(keys, "key", "left_semi"))
        wanted = self.all_pairs(lists.join(keys, "key", "left_anti"))
        self.check_new(wanted.unionByName(self._stars(long, "key", 1, differ="comp")))
        discard(lists)
        rest = self.still_apart(long, stored(self._labels()))
        discard(long)
        self.check_new(self.pairs_beside_bulk(rest))
        discard(rest)
        return stored(self._labels())

    def check_new(self, pairs: DataFrame) -> None:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        self.check(pairs.join(self.checked, ["a", "b"], "left_anti"), one_each=False)


def near_duplicates(docs: DataFrame, similar: Similarity = Similarity()) -> DataFrame:
    """Every row with the component of its document.

    Takes ``doc_id`` and ``text``; other columns are ignored. Words are lower-cased
    in A-Z and end at ASCII white space; a text with fewer words than an n-gram has
    is one gram, and one without words (or null) has none and links with nothing.
    Rows with equal sets are linked. Rows that repeat a doc_id are one document; a
    null doc_id links nothing. An empty table gives no rows. Returns doc_id,
    n_shingles (size of the set) and component_id (the smallest doc_id reachable
    over links, its own included).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = stored(rows.mapInArrow(releasing(_prints(similar)), _PRINTS))
    classes = prints.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2").agg(
        F.min(F.struct("doc_id", "reach", "sig")).alias("first"), F.count(F.lit(1)).alias("rows")
    )
    nodes = stored(
        classes.select(
            F.col("first.doc_id").alias("v"), "n", "f1", "f2", "rows",
            F.col("first.reach").alias("reach"), F.col("first.sig").alias("sig"),
        )
    )
    wide, prints = prints, stored(prints.select("doc_id", "n", "f1", "f2"))
    discard(wide)
    labels = _Join(rows, nodes, similar).run()
    same = nodes.where("rows > 1").select("n", "f1", "f2", "v")
    placed = prints.join(same, ["n", "f1", "f2"], "left")
    return (
        placed.withColumn("v", F.coalesce("v", "doc_id"))
        .join(labels, "v", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.coalesce("component", "v")).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )
