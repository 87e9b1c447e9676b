"""Mix sources to target weights by weighted fair queueing.

Every source sends its documents, in a shuffled order that repeats once it is
used up, through a queue whose rate is the source's target. A document copy ends
at the virtual time (words of the source up to its end) / target. Sorting all
copies by that time interleaves the sources in proportion to their rates; the
mix ends at virtual time 1, when the total budget has been served, and cuts the
document that each source is sending just then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import WORD, bucket_count, unit, with_running_total

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, limit: int = LIMIT
) -> DataFrame:
    """(source, source_size, target) from one row per source with its size.

    Sources by code point, null last, get the weights in turn. Filling up by
    weight until a source reaches ``limit`` times its size is the same as finding
    the level at which target = min(limit, level * weight) sums to the budget:
    with sources sorted by limit / weight, the first that stays under its limit
    gives the level. One row per source stands in one window here.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    turns = F.array(*[F.lit(int(w)) for w in weights])
    ranked = (
        sizes.withColumn("turn", (F.row_number().over(by_name) - 1) % len(weights))
        .withColumn("weight", F.element_at(turns, (F.col("turn") + 1).cast("int")))
        .withColumn("most", F.col("source_size") * limit)
        .withColumn("full_at", F.col("most") / F.col("weight"))
    )
    levels = ranked.withColumn(
        "level",
        (
            F.sum("source_size").over(everything) * share
            - F.coalesce(F.sum("most").over(earlier), F.lit(0))
        )
        / F.sum("weight").over(rest),
    ).withColumns({"open": F.col("full_at") > F.col("level"), "number": F.row_number().over(by_level)})
    level = F.min(F.when(F.col("open"), F.struct("number", "level"))).over(everything)
    return levels.withColumn("final", level["level"]).select(
        "source",
        "source_size",
        F.coalesce(
            F.least(F.col("most").cast("double"), F.col("final") * F.col("weight")),
            F.col("most").cast("double"),
        ).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
    seed: int = 2,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Every document row with the words that the mix takes from it.

    Takes ``doc_id``, ``text`` and ``source``; other columns are kept aside and
    dropped. A null or empty text has size 0 and is taken 0 times; null is a
    source of its own, after all others. Rows that repeat count one by one. The
    order inside a source is a hash of doc_id and ``seed``, so reruns agree.

    Returns doc_id, source, size, source_size, target, taken and position: the
    words of the whole mix before the first copy of this document, null if not taken.
    ``carry`` names further columns to return.
    """
    sized = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        *[F.col(c).alias(f"_carried_{i}") for i, c in enumerate(carry)],
    )
    targets = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit
    ).withColumnRenamed("source", "_source")
    buckets = bucket_count(docs.count())
    queued = with_running_total(
        sized, "before", ["source"], unit("doc_id", F.lit(seed)), ["doc_id", "size"],
        F.col("size"), buckets,
    )
    joined = queued.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    copies = (
        joined.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(limit - 1))))
        .withColumn("start", F.col("before") + F.col("copy") * F.col("source_size"))
        .withColumn("end", F.col("start") + F.col("size"))
        .withColumn("served", F.floor("target"))
        .withColumn(
            "words",
            F.greatest(
                F.lit(0), F.least(F.col("end"), F.col("served")) - F.col("start")
            ).cast("long"),
        )
        .withColumn("finish", F.when(F.col("target") > 0, F.col("end") / F.col("target")))
    )
    # Times up to 1 fill the lower half of the range, what comes too late the upper.
    spread = F.coalesce(F.col("finish") / (F.col("finish") + 1), 0.5 + unit("doc_id") / 2)
    ordered = with_running_total(
        copies, "position", [], spread,
        ["finish", "source", "doc_id", "copy", "size"], F.col("words"), 2 * limit * buckets,
    )
    taken = F.greatest(
        F.lit(0), F.least(F.col("served"), F.col("before") + F.col("size")) - F.col("before")
    )
    for again in range(1, limit):
        start = F.col("before") + again * F.col("source_size")
        taken = taken + F.greatest(
            F.lit(0), F.least(F.col("served"), start + F.col("size")) - start
        )
    return ordered.where("copy = 0").select(
        "doc_id", "source", "size", "source_size", "target",
        taken.cast("long").alias("taken"),
        F.when(taken > 0, F.col("position")).alias("position"),
        *[F.col(f"_carried_{i}").alias(c) for i, c in enumerate(carry)],
    )
