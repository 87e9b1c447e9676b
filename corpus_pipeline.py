"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes what the one before it kept, as a table with the columns of
``documents``, and hands on what it keeps itself; the last gives the packed
pieces. Every stage's result is written to the shared folder and read from there,
so a lost executor repeats one stage at most.

Texts move with their rows: a stage decides on narrow tables and then drops or
repeats rows of the scan. The ids it needs for that are broadcast where their
counted number is small, and otherwise meet the documents in a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import exact_dedup, jaccard, language, mixing, packing
from daybook.llm.common import discard, read_table, small_side, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Documents whose language is less sure than this are rejected.
LEAST_SCORE = 0.5

# Training and tokenizing cannot be written in SQL.
ORACLE_SQL = None


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key of their own: the doc_id, or a hash of id and text where ids repeat or are null.

    A doc_id then decides for no other text. Ids that nothing repeats stay what they are.
    """
    several = docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null")
    several = stored(several.select(F.col("doc_id").alias("several_id")))
    hashed = F.xxhash64("doc_id", "text")
    alone = F.coalesce(F.col("doc_id").cast("long"), hashed)
    if several.isEmpty():
        return docs.withColumn("key", alone)
    joined = docs.join(small_side(several), F.col("doc_id") == F.col("several_id"), "left")
    key = F.when(F.col("several_id").isNull(), alone).otherwise(hashed)
    return joined.withColumn("key", key).drop("several_id")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows whose doc_id and key are not among those of ``gone``; nulls are equal."""
    named = stored(gone.select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key")))
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key"))
    return docs.join(small_side(named), same, "left_anti")


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the corpus.

    Rejected are texts without a letter (null and empty ones too) and those whose
    best language scores below ``LEAST_SCORE``.
    """
    model = language.learn_language(docs)
    found = docs.select(*COLUMNS, language.language_of(model)("text").alias("found"))
    sure = (F.col("found.lang") != language.UNKNOWN) & (F.col("found.score") >= LEAST_SCORE)
    return found.where(sure).select(COLUMNS)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; rows that repeat stay once.

    Null, empty and blank texts are equal. Decides per doc_id and text, so another text
    under the same doc_id, null included, stays. An empty table gives no rows.
    """
    docs = docs.select(COLUMNS)
    groups = exact_dedup.duplicate_groups(docs).where("group_size > 1")
    named = stored(
        groups.groupBy("doc_id", F.col("text_sha256").alias("key")).agg(
            F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")
        )
    )
    digest = F.sha2(exact_dedup.normalised(F.col("text")), 256)
    left = _without(docs.withColumn("key", digest), named.where("not kept"))
    several = stored(
        named.where("kept and rows > 1").select(
            F.col("doc_id").alias("one_id"), F.col("key").alias("one_key")
        )
    )
    if several.isEmpty():
        return left.select(COLUMNS)
    same = F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("key") == F.col("one_key"))
    once = left.join(several, same, "left_anti")
    first = F.max_by(F.struct(*COLUMNS), F.coalesce(F.length("text"), F.lit(0)))
    again = left.join(several, same, "left_semi").groupBy("doc_id", "key").agg(first.alias("row"))
    return once.select(COLUMNS).unionByName(again.select("row.*"))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near copies.

    Near copies share 0.8 of their five-word grams, or are linked by others that do.
    Texts without words have none. Decides per doc_id and text (a null doc_id comes
    last), so another text under the same doc_id stays; rows that repeat both are one
    document and stay or go together. An empty table gives no rows.
    """
    docs = docs.select(COLUMNS)
    keyed = _keyed(docs)
    groups = jaccard.near_duplicates(
        keyed.select(F.col("key").alias("doc_id"), "text"),
        jaccard.Similarity(words=5, part=80, of=100),
    )
    # Few rows beside all documents: those of groups, by their keys.
    linked = stored(groups.select(F.col("doc_id").alias("of"), "component_id").distinct())
    sizes = linked.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    linked = stored(linked.join(small_side(stored(sizes.select("component_id"))), "component_id"))
    members = stored(
        keyed.join(small_side(linked), F.col("key") == F.col("of"))
        .select("doc_id", "key", "component_id")
        .distinct()
    )
    order = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "key")
    stays = members.groupBy(F.col("component_id").alias("component")).agg(F.min(order).alias("first"))
    others = members.join(stays, F.col("component_id") == F.col("component")).where(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key")))
    )
    return _without(keyed, others).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix takes them.

    The mix cuts the document that a source is sending when the budget ends; here
    such a document goes in whole if at least half of it is taken. Texts without words
    are never taken. Decides per doc_id, text and source; null is a source of its own.
    An empty table gives no rows.
    """
    docs = docs.select(COLUMNS)
    key = F.xxhash64("doc_id", "text", "source")
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)
    taken = (
        mixing.mix(docs.withColumn("key", key), carry=["key"])
        .groupBy(F.col("doc_id").alias("taken_id"), F.col("key").alias("taken_key"))
        .agg(F.max(times).cast("int").alias("times"))
        .where("times > 0")
    )
    side = small_side(stored(taken))
    same = F.col("doc_id").eqNullSafe(F.col("taken_id")) & (F.col("key") == F.col("taken_key"))
    return (
        docs.withColumn("key", key)
        .join(side, same)
        .withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(COLUMNS)
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences; a document the mix repeats is packed as often.

    A null or empty text gives its closing id only; an empty table gives no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("language", keep_known_language),
    ("exact copies", remove_copies),
    ("near copies", remove_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents").select(COLUMNS)
    before = None
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        if before is not None:  # read for the last time
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
