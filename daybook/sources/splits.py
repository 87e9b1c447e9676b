"""Ranges of a column that hold about equally many rows, from counts the source makes.

Equal widths give one task nearly everything where ids are dense in one place. Here
the source counts rows in a few hundred equal-width buckets, and again inside the
buckets that are too full, until every cut is near the wanted share. Only counts come
back, a few hundred rows a round, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

# Buckets a round, and rounds: each round narrows a bucket by that factor.
BUCKETS, ROUNDS = 256, 8
# A cut may be off by this part of one task's share.
TOLERANCE = 0.02

# (low, width) -> (bucket number, rows) of the rows from low on; a bucket without rows may be left out.
CountBuckets = Callable[[int, int, int], Iterable[tuple[int, int]]]


@dataclass(frozen=True)
class Range:
    """``low <= value < high``; an open end is None, and nulls go with the first range."""

    low: int | None
    high: int | None

    def sql(self, column: str) -> str:
        parts = [f"{column} >= {self.low}"] * (self.low is not None)
        parts += [f"{column} < {self.high}"] * (self.high is not None)
        condition = " AND ".join(parts) or "1 = 1"
        return condition if self.low is not None else f"({condition} OR {column} IS NULL)"


def balanced_ranges(low: int, high: int, tasks: int, count_buckets: CountBuckets) -> list[Range]:
    """At most ``tasks`` ranges of the values from ``low`` to ``high``, nearly equal in rows.

    ``count_buckets(first, width, buckets)`` counts the rows of ``buckets`` ranges of
    ``width`` values from ``first`` on. A single value that holds more than a share
    cannot be cut; the ranges beside it are smaller then, or fewer.
    """
    known = _counted(low, high, count_buckets)
    total = sum(rows for _, _, rows in known)
    share = total / tasks
    for _ in range(ROUNDS - 1):
        coarse = _to_refine(known, share, tasks)
        if not coarse:
            break
        finer = []
        for bucket in known:
            first, width, _ = bucket
            finer += _counted(first, first + width - 1, count_buckets) if bucket in coarse else [bucket]
        known = finer
    return _cut(known, share, tasks)


def _counted(low: int, high: int, count_buckets: CountBuckets) -> list[tuple[int, int, int]]:
    """(first value, width, rows) of the buckets that have rows, in order."""
    width = max(1, -(-(high - low + 1) // BUCKETS))
    buckets = -(-(high - low + 1) // width)
    found = dict(count_buckets(low, width, buckets))
    return [
        (first := low + i * width, min(width, high - first + 1), found[i])
        for i in sorted(found)
        if found[i]
    ]


def _to_refine(known: list, share: float, tasks: int) -> set:
    """The buckets that a cut falls into, too far from both of their ends."""
    coarse, before, wanted = set(), 0, 1
    for bucket in known:
        _, width, rows = bucket
        while wanted < tasks and before + rows >= wanted * share:
            off = min(wanted * share - before, before + rows - wanted * share)
            if width > 1 and off > TOLERANCE * share:
                coarse.add(bucket)
            wanted += 1
        before += rows
    return coarse


def _cut(known: list, share: float, tasks: int) -> list[Range]:
    """Cut before buckets that have rows, so that every range has some."""
    cuts, before, wanted = set(), 0, 1
    for at, (first, _, rows) in enumerate(known):
        while wanted < tasks and before + rows >= wanted * share:
            if wanted * share - before < before + rows - wanted * share:
                cuts.add(first)
            elif at + 1 < len(known):
                cuts.add(known[at + 1][0])
            wanted += 1
        before += rows
    ends = sorted(cuts - {known[0][0]} if known else cuts)
    return [Range(a, b) for a, b in zip([None, *ends], [*ends, None], strict=True)]
