"""Shards of near equal bytes by k-d tree partitioning.

Documents are points: length of the text, source, language and doc_id, each
scaled to the same range. A node is cut at the weighted median along the axis on
which it is widest, weights being bytes, until each leaf is one shard. Medians
come from distributed histograms: every round sums bytes in at most 1,024 bins
per node and looks closer at the bin that holds the median. The driver sees
those sums only, at most shards x 1,024 of them.

Copies of a text have the coordinates of the first of them and so stay in one
shard. Only a group heavier than an eighth of a shard is dealt out row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import bucket_count, stored, unit, with_running_total

SHARDS = 16
BINS = 1024
# A median bin of at most this share of its node is not looked into further.
CLOSE = 0.0005
AXES = ("length", "source", "lang", "doc_id")
_SPAN = (1 << 30) - 1


def _points(docs: DataFrame, shards: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("fp"),
        F.length(text).cast("long").alias("n"),
        "source",
        "lang",
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows)
    total = rows.agg(F.sum("size")).first()[0] or 0
    copies = (
        rows.groupBy("fp")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("size").alias("weight"),
            F.min(F.struct("doc_id", "source", "lang")).alias("first"),
        )
        .where("rows > 1")
    )
    alone = F.struct("doc_id", "source", "lang")
    joined = rows.join(copies, "fp", "left").withColumn("at", F.coalesce("first", alone))
    heavy = F.coalesce(F.col("weight"), F.lit(0)) > total / (8 * shards)
    low = F.lit((1 << 32) - 1)
    limits = rows.agg(F.max("n"), F.min("doc_id"), F.max("doc_id")).first()
    longest, first, last = (x or 0 for x in limits)
    hashed = lambda *cols: F.shiftrightunsigned(F.xxhash64(*cols), 34)
    # As decimals: ids may lie further apart than a long can tell.
    wide = lambda x: x.cast("decimal(20,0)")
    scaled = lambda c, lo, hi: F.least(
        F.floor(
            (wide(F.coalesce(c, F.lit(lo))) - wide(F.lit(lo))).cast("double")
            / F.lit(float(max(1, hi - lo)))
            * _SPAN
        ).cast("long"),
        F.lit(_SPAN).cast("long"),
    )
    return stored(
        joined.select(
            "doc_id",
            "size",
            "text_crc32",
            "row",
            F.array(
                scaled(F.col("n"), 0, longest),
                hashed(F.col("at.source"), F.lit("source")),
                hashed(F.col("at.lang"), F.lit("lang")),
                scaled(F.col("at.doc_id"), first, last),
            ).alias("x"),
            F.when(heavy, F.xxhash64("doc_id", "row")).otherwise(F.col("fp")).bitwiseAND(low).alias("tie"),
            F.lit(0).alias("node"),
        )
    )


def _of_node(values: dict[int, int]) -> Column:
    """The value of a row's node; at most one entry per shard."""
    pairs = [F.lit(x) for node, value in values.items() for x in (node, value)]
    return F.element_at(F.create_map(*pairs), F.col("node"))


def _keyed(placed: DataFrame, axis: dict[int, int]) -> DataFrame:
    """The coordinate in the high bits; ties are told apart by the text's hash."""
    at = F.element_at("x", _of_node({node: a + 1 for node, a in axis.items()}))
    return placed.withColumn("key", F.shiftleft(at, 32).bitwiseOR(F.col("tie")))


def _split(placed: DataFrame, shards: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """Cut every node with more than one shard; one job per round for all nodes together.

    A node is named by its first shard, and ``shards`` has how many it holds.
    """
    todo = [node for node, n in shards.items() if n > 1]
    spans = placed.where(F.col("node").isin(todo)).groupBy("node").agg(
        F.sum("size").alias("weight"),
        *[F.min(F.element_at("x", a + 1)).alias(f"low{a}") for a in range(len(AXES))],
        *[F.max(F.element_at("x", a + 1)).alias(f"high{a}") for a in range(len(AXES))],
    )
    axis: dict[int, int] = {}
    low, high, below, want, total = {}, {}, {}, {}, {}
    for r in spans.collect():
        node = r["node"]
        axis[node] = max(range(len(AXES)), key=lambda a: r[f"high{a}"] - r[f"low{a}"])
        low[node] = r[f"low{axis[node]}"] << 32
        high[node] = (r[f"high{axis[node]}"] + 1) << 32
        total[node], below[node] = r["weight"], 0
        want[node] = r["weight"] * (shards[node] // 2) / shards[node]
    if not axis:
        return placed, {node: 1 for node in shards}
    keyed = _keyed(placed, axis)
    cut: dict[int, int] = {}
    while open_ := [node for node in axis if node not in cut]:
        width = {node: max(1, -(-(high[node] - low[node]) // BINS)) for node in open_}
        # Strings keep the literals' type the same for small and large values.
        long = lambda values: _of_node({n: str(values[n]) for n in open_}).cast("long")  # noqa: E731, B023
        looked = keyed.where(F.col("node").isin(open_)).withColumns(
            {"low": long(low), "high": long(high), "width": long(width)}
        )
        bins = (
            looked.where("key >= low and key < high")
            .groupBy("node", F.expr("(key - low) div width").alias("bin"))
            .agg(F.sum("size").alias("weight"), F.min("key").alias("min"), F.max("key").alias("max"))
        )
        sums: dict[int, list] = {node: [] for node in open_}
        for r in bins.collect():
            sums[r["node"]].append((r["min"], r["max"], r["weight"]))
        for node in open_:
            upto = below[node]
            for first, last, weight in sorted(sums[node]):
                if upto + weight >= want[node]:
                    break
                upto += weight
            if weight <= CLOSE * total[node] or first == last:
                nearer = want[node] - upto < upto + weight - want[node]
                cut[node] = first if nearer else last + 1
            else:
                low[node], high[node], below[node] = first, last + 1, upto
    parts = {node: n for node, n in shards.items() if node not in cut}
    for node in cut:
        left = shards[node] // 2
        parts |= {node: left, node + left: shards[node] - left}
    keyed = keyed.where(F.col("node").isin(list(cut)))
    above = F.col("key") >= _of_node({n: str(c) for n, c in cut.items()}).cast("long")
    step = _of_node({node: shards[node] // 2 for node in cut})
    moved = keyed.withColumn("node", F.col("node") + F.when(above, step).otherwise(0))
    whole = placed.where(~F.col("node").isin(list(cut)))
    return stored(moved.select(placed.columns).unionByName(whole)), parts


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row with its shard and its place there.

    Takes ``doc_id``, ``text``, ``source`` and ``lang``; other columns are
    ignored. Size is the UTF-8 bytes of the text (null: none) plus 1, and the
    shards' sums of sizes come out near equal. Nulls in source and language are
    points of their own; a null doc_id counts as the smallest. Rows that repeat
    are separate rows with equal texts. An empty table gives no rows. Returns
    doc_id, size, text_crc32, shard and slot, gapless from 0 in each shard.
    """
    placed, parts = _points(docs, shards), {0: shards}
    rows = placed.count()
    while max(parts.values()) > 1:
        placed, parts = _split(placed, parts)
    placed = placed.select("doc_id", "size", "text_crc32", "row", F.col("node").alias("shard"))
    # Spread by the row's own number, so rows that repeat an id are many ranges as well.
    return with_running_total(
        placed, "slot", ["shard"], unit("doc_id", "row"), ["doc_id", "text_crc32", "row"],
        F.lit(1).cast("long"), bucket_count(rows),
    ).drop("row")
