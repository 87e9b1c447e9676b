"""A Merkle manifest of a dataset, its proofs found by a butterfly exchange.

Every language is a tree of fixed fanout over its documents in the order of their
ids, and the roots of the languages are the leaves of one more tree. The leaves of
a tree are cut into blocks that are aligned with its nodes. A block hashes its own
subtree; then, round by round, the blocks of each aligned group swap the roots they
have: a block meets those that differ from it in one digit of the block number, and
all of them hash the common ancestor. After the last round every block holds its
whole way to the root, so nothing has to be sent back down the tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import bucket_count, discard, small_side, stored

FANOUT = 8
# Levels of the tree inside one block: 4,096 leaves at the usual fanout.
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Leaves that one task sorts.
SORTED_ROWS = 50_000
PROOF = "array<struct<place:int,siblings:array<string>>>"
_IN_PARTITION = 33  # bits of monotonically_increasing_id below the partition


def record_digest(*fields: Column) -> Column:
    """Lowercase hex sha256 of the fields: ``-`` for null, else byte count, ``:``, value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        size = F.octet_length(value).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof lead to."""

    def up(node: Column, step: Column) -> Column:
        siblings = step["siblings"]
        left = F.slice(siblings, F.lit(1), step["place"])
        right = F.slice(siblings, step["place"] + 1, F.size(siblings))
        return F.sha2(F.concat(F.array_join(left, ""), node, F.array_join(right, "")), 256)

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """sha256 of all siblings of a proof, from the leaf to the root."""
    levels = F.transform(proof, lambda step: F.array_join(step["siblings"], ""))
    return F.sha2(F.array_join(levels, ""), 256)


def levels_above(count: int, fanout: int) -> int:
    """Levels between ``count`` nodes and the single node above them."""
    levels = 0
    while count > 1:
        count, levels = -(-count // fanout), levels + 1
    return levels


def _digest(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _subtree(leaves: list[str], fanout: int, levels: int) -> list[list[str]]:
    """The nodes of ``levels`` + 1 levels; a run of one node is hashed as well."""
    tree = [leaves]
    for _ in range(levels):
        below = tree[-1]
        tree.append([_digest(below[at : at + fanout]) for at in range(0, len(below), fanout)])
    return tree


def _block_leaves(block: pa.Table) -> pa.Table:
    return block.sort_by([("index", "ascending")])


def _block_root(fanout: int):
    def run(block: pa.Table) -> pa.Table:
        leaves = _block_leaves(block).column("leaf").to_pylist()
        levels = min(BLOCK_LEVELS, levels_above(block.column("leaves")[0].as_py(), fanout))
        return pa.table(
            {
                "tree": block.column("tree").slice(0, 1),
                "block": block.column("block").slice(0, 1),
                "leaves": block.column("leaves").slice(0, 1),
                "node": [_subtree(leaves, fanout, levels)[-1][0]],
            }
        )

    return run


def _with_proofs(fanout: int, kept: list[str], schema: pa.Schema):
    """Proofs of the leaves of one block: inside the block, then those it was sent."""

    def run(block: pa.Table, above: pa.Table) -> pa.Table:
        rows, way = _block_leaves(block), above.to_pylist()[0]
        leaves = rows.column("leaf").to_pylist()
        levels = min(BLOCK_LEVELS, levels_above(rows.column("leaves")[0].as_py(), fanout))
        tree = _subtree(leaves, fanout, levels)
        proofs = []
        for at in range(len(leaves)):
            proof = []
            for nodes in tree[:levels]:
                first, place = at - at % fanout, at % fanout
                run_of = nodes[first : first + fanout]
                proof.append({"place": place, "siblings": run_of[:place] + run_of[place + 1 :]})
                at //= fanout
            proofs.append(proof + way["proof"])
        columns = [rows.column(name) for name in kept]
        columns += [pa.array([way[name]] * len(leaves), pa.string()) for name in ("subroot", "root")]
        columns.append(pa.array(proofs, schema.field("proof").type))
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def _exchange(nodes: DataFrame, fanout: int, rounds: int) -> DataFrame:
    """Swap roots between aligned groups of blocks until every block has its tree's root.

    Takes tree, block, blocks (of the tree), node and proof, one row per block, and
    returns them with the root as node and the longer proof. In round r a block is
    sent the roots of its group by the blocks that share its other digits, or by the
    last block of a subtree that ends before. One row per block and sender moves.
    """
    for number in range(rounds):
        low = fanout**number
        group = F.floor(F.col("block") / (low * fanout)) * fanout
        member = F.explode(F.sequence(F.lit(0), F.lit(fanout - 1)))
        asked = (
            nodes.where(F.col("blocks") > low)
            .select("tree", "block", "blocks", "proof", member.alias("member"), group.alias("group"))
            .withColumn("first", (F.col("group") + F.col("member")) * low)
            .where("first < blocks")
            .withColumn(
                "sender",
                F.least(F.col("first") + F.col("block") % low, F.col("blocks") - 1).cast("long"),
            )
        )
        sent = nodes.select(
            F.col("tree").alias("_tree"), F.col("block").alias("sender"), F.col("node").alias("sent")
        )
        met = asked.join(sent, (F.col("tree") == F.col("_tree")) & (asked.sender == sent.sender))
        place = F.floor(F.col("block") / low) % fanout
        # At most ``fanout`` rows meet in a group.
        heard = (
            met.groupBy("tree", "block", "blocks", "proof")
            .agg(F.array_sort(F.collect_list(F.struct("member", "sent"))).alias("heard"))
            .withColumn("place", place.cast("int"))
        )
        step = F.struct(
            F.col("place"),
            F.transform(
                F.filter("heard", lambda x: x["member"] != F.col("place")), lambda x: x["sent"]
            ).alias("siblings"),
        )
        joined = heard.select(
            "tree", "block", "blocks",
            F.sha2(F.array_join(F.transform("heard", lambda x: x["sent"]), ""), 256).alias("node"),
            F.concat("proof", F.array(step)).alias("proof"),
        )
        still = nodes.where(F.col("blocks") <= low).select(joined.columns)
        nodes = stored(joined.unionByName(still), release=False)
    return nodes


def _largest(df: DataFrame, column: str) -> int:
    return df.agg(F.max(column)).first()[0] or 0


def manifest(
    docs: DataFrame, fanout: int = FANOUT, carry: Sequence[str] = ()
) -> DataFrame:
    """Every document as a leaf, with its proof up to the root of the dataset.

    Takes the columns of ``FIELDS``; ``carry`` names further ones to keep, others are
    ignored. A leaf is the digest of its fields, nulls included. Null is a language
    of its own, before all others. In a language leaves ascend by doc_id (null
    first), rows that repeat a doc_id by digest; equal digests are interchangeable.
    A language of one leaf has that leaf as its root, and a dataset of one language
    the root of that. An empty table gives no rows.

    Returns doc_id, the carried columns, leaf, subroot, root and proof: for each
    level, from the leaf up, the place among the children and the other children.
    Texts are read once; after that a leaf moves as its digest and id.
    """
    read = docs.select(
        "doc_id", "lang", record_digest(*[F.col(c) for c in FIELDS]).alias("leaf"),
        *[F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)],
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = stored(read)
    tasks = bucket_count(leaves.count(), SORTED_ROWS)
    order = [F.col(c).asc_nulls_first() for c in ("lang", "doc_id", "leaf", "row")]
    # The row's own number ends every tie, so many copies are cut as well.
    ranged = stored(
        leaves.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
        .drop("row")
    )

    # (language, sorted task) -> position of its first leaf; few rows per task.
    task = F.shiftright("at", _IN_PARTITION)
    by_task = Window.partitionBy("lang").orderBy("task")
    before = by_task.rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(
        ranged.groupBy("lang", task.alias("task"))
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
        .withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))),
        release=False,
    )
    trees = _numbered_trees(runs)
    placed_runs = stored(
        runs.join(trees, runs.lang.eqNullSafe(trees.tree_lang)).select(
            F.col("lang").alias("run_lang"), F.col("task").alias("run_task"),
            "first", "before", "tree", "leaves",
        ),
        release=False,
    )
    block_size = fanout**BLOCK_LEVELS
    placed = stored(
        ranged.join(
            small_side(placed_runs),
            ranged.lang.eqNullSafe(F.col("run_lang")) & (task == F.col("run_task")),
        )
        .withColumn("index", F.col("before") + F.col("at") - F.col("first"))
        .withColumn("block", F.floor(F.col("index") / block_size))
        .drop("run_lang", "run_task", "first", "before", "at")
    )
    discard(leaves)
    discard(ranged)

    # Inside the blocks, then across them, then across the languages.
    roots = placed.select("tree", "block", "index", "leaf", "leaves").groupBy("tree", "block")
    blocks = stored(
        roots.applyInArrow(_block_root(fanout), "tree long, block long, leaves long, node string")
        .withColumn("blocks", F.ceil(F.col("leaves") / block_size))
        .withColumn("proof", F.array().cast(PROOF))
        .drop("leaves")
    )
    blocks = _exchange(blocks, fanout, levels_above(_largest(blocks, "blocks"), fanout))
    subroots = blocks.where("block = 0").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("block"),
        F.col("node"), F.array().cast(PROOF).alias("proof"),
    )
    languages = trees.count()
    tops = _exchange(
        subroots.withColumn("blocks", F.lit(languages).cast("long")),
        fanout,
        levels_above(languages, fanout),
    ).select(
        F.col("block").alias("top_tree"), F.col("node").alias("root"), F.col("proof").alias("top"),
    )
    ways = blocks.join(tops, F.col("tree") == F.col("top_tree")).select(
        "tree", "block", F.col("node").alias("subroot"), "root",
        F.concat("proof", "top").alias("proof"),
    )

    kept = ["doc_id", *[f"carried_{i}" for i in range(len(carry))], "leaf"]
    schema = T.StructType(
        [placed.schema[c] for c in kept]
        + [T.StructField(c, T.StringType()) for c in ("subroot", "root")]
        + blocks.select("proof").schema.fields
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    proven = (
        placed.groupBy("tree", "block")
        .cogroup(ways.groupBy("tree", "block"))
        .applyInArrow(_with_proofs(fanout, kept, to_arrow_schema(schema)), schema)
    )
    for at, name in enumerate(carry):
        proven = proven.withColumnRenamed(f"carried_{at}", name)
    return proven


def _numbered_trees(runs: DataFrame) -> DataFrame:
    """(tree_lang, tree, leaves): the languages numbered in their order.

    The runs are sorted, so languages follow each other as their first leaves do:
    numbered inside the task that their first leaf lies in, after the languages of
    the tasks before. The one window without a key has a row per sorted task.
    """
    first = runs.groupBy(F.col("lang").alias("tree_lang")).agg(
        F.min("first").alias("first"), F.sum("rows").alias("leaves"), F.min("task").alias("task")
    )
    starts = first.groupBy(F.col("task").alias("start_task")).count()
    before = Window.orderBy("start_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("start_task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(Window.partitionBy("task").orderBy("first"))
    return stored(
        first.withColumn("inside", inside - 1)
        .join(starts, F.col("task") == F.col("start_task"))
        .select("tree_lang", (F.col("earlier") + F.col("inside")).alias("tree"), "leaves"),
        release=False,
    )
