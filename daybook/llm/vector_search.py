"""Exact top-k inner products over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it; the distances
of a pivot are cut into rings of equal counts. For a query q, the triangle
inequality bounds how near any vector of a ring can be, and with it the inner
product, since 2 q.x = |q|^2 + |x|^2 - |q - x|^2. A first wave looks into the
rings with the highest bounds until they hold enough vectors; the k-th score
found there is the bar that the bound of every other ring has to reach for the
second wave. Rings below the bar cannot hold a better or equal score.

Work is dealt in tiles of at most about a thousand vectors by five hundred
queries of one ring, so that no ring, however full, is one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import stored, unit

PIVOTS = 16
RINGS = 8
SAMPLE_VECTORS = 4_096
TILE_VECTORS = 1_024
TILE_QUERIES = 512
# Vectors that the rings of the first wave hold together, at least.
FIRST_WAVE = 2_048

_PAIRS = "query_id long, vec_id long, score long"


@dataclass
class Rings:
    """Per ring its pivot, nearest and farthest distance, largest norm and count."""

    pivots: np.ndarray
    pivot: np.ndarray
    near: np.ndarray
    far: np.ndarray
    norm: np.ndarray
    count: np.ndarray

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """An upper bound of the inner product of a query with the vectors of each ring."""
        to_pivot = np.sqrt(((self.pivots - query) ** 2).sum(axis=1))[self.pivot]
        gap = np.maximum(0.0, np.maximum(self.near - to_pivot, to_pivot - self.far))
        size = float(query @ query)
        by_distance = (size + self.norm**2 - gap**2) / 2
        bound = np.minimum(by_distance, np.sqrt(size) * self.norm)
        return bound + 1e-6 * np.abs(bound) + 1e-3

    def first(self, bounds: np.ndarray) -> np.ndarray:
        order = np.argsort(-bounds, kind="stable")
        enough = np.searchsorted(np.cumsum(self.count[order]), FIRST_WAVE) + 1
        return order[:enough]


def integer_vectors(table: DataFrame, scale: int) -> DataFrame:
    """vec_id and floor(scale * x) of each component; vectors with unusable components are left out."""
    x = F.col("embedding")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    usable = table.where(x.isNotNull() & F.col("vec_id").isNotNull()).where(F.forall(x, finite))
    return usable.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double"))).alias("v"),
    )


def fit_pivots(sample: np.ndarray, pivots: int = PIVOTS, rounds: int = 8) -> np.ndarray:
    """Means of ``pivots`` clusters of the sample."""
    rng = np.random.default_rng(8)
    centres = sample[rng.choice(len(sample), min(pivots, len(sample)), replace=False)]
    for _ in range(rounds):
        near = _distances(sample, centres).argmin(axis=1)
        centres = np.array(
            [sample[near == k].mean(axis=0) if (near == k).any() else c for k, c in enumerate(centres)]
        )
    return centres


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((vectors - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of integers; a vector shorter than others has zeros at the end."""
    out = np.zeros((len(column), dim), np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return values.reshape(len(column), dim).astype(np.int64)
    at = 0
    for row, n in zip(out, lengths, strict=True):
        row[:n] = values[at : at + n]
        at += n
    return out


def _keyed(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1), pivots.shape[1])
            real = vectors.astype(np.float64)
            distances = _distances(real, pivots)
            nearest = distances.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.array(nearest, pa.int32()),
                    pa.array(distances[np.arange(len(real)), nearest], pa.float64()),
                    pa.array(np.sqrt((real**2).sum(axis=1)), pa.float64()),
                ],
                names=["vec_id", "vec", "pivot", "distance", "norm"],
            )

    return run


def build_index(vectors: DataFrame, pivots: np.ndarray, rings: int = RINGS) -> DataFrame:
    """vec_id, vec, pivot, ring, distance and norm of every vector."""
    keyed = stored(
        vectors.mapInArrow(
            _keyed(pivots), "vec_id long, vec binary, pivot int, distance double, norm double"
        )
    )
    cuts = [i / rings for i in range(1, rings)]
    edges = keyed.groupBy("pivot").agg(F.percentile_approx("distance", cuts, 1000).alias("edges"))
    known = dict(edges.collect())
    pairs = [c for p, e in known.items() for c in (F.lit(p), F.array(*[F.lit(float(v)) for v in e]))]
    beyond = F.filter(F.element_at(F.create_map(*pairs), F.col("pivot")), lambda e: F.col("distance") > e)
    return keyed.withColumn("ring", F.size(beyond) + F.col("pivot") * rings)


def _summary(index: DataFrame, pivots: np.ndarray, rings: int) -> tuple[Rings, list[int]]:
    """The rings that hold vectors, and their names; at most pivots x rings rows."""
    found = index.groupBy("ring").agg(
        F.count(F.lit(1)).alias("n"), F.min("distance").alias("near"),
        F.max("distance").alias("far"), F.max("norm").alias("norm"),
    ).orderBy("ring").collect()
    column = lambda name: np.array([r[name] for r in found], np.float64)
    names = [r["ring"] for r in found]
    pivot = np.array(names, int) // rings
    return Rings(pivots, pivot, column("near"), column("far"), column("norm"), column("n")), names


def _waves(rings: Rings, names: list[int], first: bool):
    """Rows (ring, query_id, vec, bar) for the rings that a query looks into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, list, list, list] = ([], [], [], [])
            for query_id, vec, bar in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bounds = rings.bounds(np.frombuffer(vec, np.int64).astype(np.float64))
                chosen = rings.first(bounds)
                if not first:
                    done = set(chosen.tolist())
                    reach = np.flatnonzero(bounds >= (-np.inf if bar is None else bar))
                    chosen = [r for r in reach if r not in done]
                for ring in chosen:
                    for out, value in zip(rows, (names[ring], query_id, vec, bar), strict=True):
                        out.append(value)
            types = (pa.int32(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, types, strict=True)],
                names=["ring", "query_id", "vec", "bar"],
            )

    return run


def _tile(k: int):
    """The k best vectors of a tile for each of its queries."""

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if vectors.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        vectors = vectors.sort_values("vec_id", kind="stable")
        ids, own = vectors["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        a = np.frombuffer(b"".join(vectors["vec"]), np.int64).reshape(len(ids), -1)
        q = np.frombuffer(b"".join(queries["vec"]), np.int64).reshape(len(own), -1)
        most = float(np.abs(a).max(initial=0)) * float(np.abs(q).max(initial=0)) * a.shape[1]
        if most < 2.0**53:  # then sums of products are exact as doubles
            scores = (q.astype(np.float64) @ a.T.astype(np.float64)).astype(np.int64)
        else:
            scores = q @ a.T
        bar = queries["bar"].fillna(np.iinfo(np.int64).min).to_numpy().astype(np.float64)
        usable = (own[:, None] != ids[None, :]) & (scores >= bar[:, None])
        n = len(ids)
        if most * n < 2.0**62:
            # One number that sorts by score and then by smaller vec_id.
            key = scores * n - np.arange(n)
            key[~usable] = -(1 << 62)
            take = min(k, n)
            best = np.argpartition(-key, take - 1, axis=1)[:, :take] if take < n else np.tile(np.arange(n), (len(own), 1))
        else:
            best = np.stack([np.lexsort((np.arange(n), -s, ~u))[:k] for s, u in zip(scores, usable, strict=True)])
        row = np.repeat(np.arange(len(own)), best.shape[1])
        col = best.ravel()
        good = usable[row, col]
        row, col = row[good], col[good]
        return pd.DataFrame({"query_id": own[row], "vec_id": ids[col], "score": scores[row, col]})

    return run


def _search(index: DataFrame, asked: DataFrame, counts: dict[int, int], k: int) -> DataFrame:
    """The k best vectors of every tile, for the rings that the queries ask for."""
    # How many parts a ring's vectors and queries come in; bounded by the rings.
    wanted = dict(asked.groupBy("ring").count().collect())
    if not wanted:
        return asked.sparkSession.createDataFrame([], _PAIRS)
    parts = {r: -(-counts[r] // TILE_VECTORS) for r in wanted}
    turns = {r: -(-n // TILE_QUERIES) for r, n in wanted.items()}
    of = lambda values: F.element_at(
        F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("ring")
    )
    part, turn = of(parts), of(turns)
    dealt = lambda name, n: F.floor(unit(name, F.lit("tile")) * n).cast("int")
    others = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    vectors = index.where(F.col("ring").isin(list(wanted))).select(
        "ring", "vec_id", "vec", dealt("vec_id", part).alias("part"), others(turn).alias("turn")
    )
    queries = asked.select(
        "ring", "query_id", "vec", "bar", dealt("query_id", turn).alias("turn"), others(part).alias("part")
    )
    keys = ["ring", "part", "turn"]
    return vectors.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        lambda left, right: _tile(k)(left, right), _PAIRS
    )


def _best(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(table: DataFrame, is_query, k: int = 20, scale: int = 64) -> DataFrame:
    """The k vectors with the highest integer inner product for every query row.

    Takes ``vec_id`` and ``embedding``; other columns are ignored. ``is_query`` is
    a condition on vec_id. Vectors that are null or hold null or non-finite
    components, or have no vec_id, take no part; a shorter vector counts as having zeros at its end.
    Ties go to the smaller vec_id. A query never finds its own vec_id; of rows that
    repeat a vec_id all are searched, and one (the smallest vector) asks. Fewer
    than k others give fewer rows, an empty table none. Scores must fit a long.
    Pivots are fitted on about ``SAMPLE_VECTORS`` vectors; all are indexed.
    Returns query_id, rank from 1, vec_id and score.
    """
    spark = table.sparkSession
    vectors = integer_vectors(table, scale)
    total, dim = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    share = SAMPLE_VECTORS / total
    drawn = vectors.where(unit("vec_id", F.lit("pivots")) < share) if share < 1 else vectors
    drawn = drawn.orderBy("vec_id").toPandas()["v"]
    sample = np.zeros((max(1, len(drawn)), dim or 0))
    for row, v in zip(sample, drawn, strict=False):
        row[: len(v)] = v
    pivots = fit_pivots(sample)
    index = stored(build_index(vectors, pivots))
    rings, names = _summary(index, pivots, RINGS)
    counts = {name: int(n) for name, n in zip(names, rings.count, strict=True)}

    asking = index.where(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    queries = asking.select("vec_id", "vec", F.lit(None).cast("long").alias("bar"))
    schema = "ring int, query_id long, vec binary, bar long"
    found = stored(
        _best(_search(index, stored(queries.mapInArrow(_waves(rings, names, True), schema)), counts, k), k)
    )
    bars = found.where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").alias("bar")
    )
    again = asking.join(bars, "vec_id", "left").select("vec_id", "vec", "bar")
    more = _search(index, stored(again.mapInArrow(_waves(rings, names, False), schema)), counts, k)
    return _best(found.drop("rank").unionByName(more), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
