"""Readers of the source tables, with source-side filters and split reads."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.rebase import rebase_order_dates, source_days
from daybook.sources.splits import Range, balanced_ranges

Value = int | str | date


@dataclass(frozen=True)
class SourceFilter:
    """A filter applied by the source: equality with one of ``values``, or greater than one."""

    column: str
    operator: str
    values: tuple[Value, ...]

    def __post_init__(self) -> None:
        if self.operator not in ("in", ">") or not self.values:
            raise ValueError(f"unsupported source filter: {self}")
        if self.operator == ">" and len(self.values) != 1:
            raise ValueError(f"unsupported source filter: {self}")

    @staticmethod
    def equals(column: str, *values: Value) -> SourceFilter:
        return SourceFilter(column, "in", values)

    @staticmethod
    def greater(column: str, value: Value) -> SourceFilter:
        return SourceFilter(column, ">", (value,))

    def condition(self) -> Column:
        column = F.col(self.column)
        if self.operator == ">":
            return column > F.lit(self.values[0])
        if len(self.values) == 1:
            return column == F.lit(self.values[0])
        return column.isin(*self.values)

    def sql(self, quote: str) -> str:
        literals = [
            str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
            for v in self.values
        ]
        name = f"{quote}{self.column}{quote}"
        if self.operator == ">":
            return f"{name} > {literals[0]}"
        return f"{name} IN ({', '.join(literals)})"


@dataclass(frozen=True)
class Split:
    """Read in ``tasks`` parallel ranges of ``column`` with about equally many rows."""

    column: str
    tasks: int = 2


class Reader(Protocol):
    def read(
        self, table: str, where: SourceFilter | None = None, split: Split | None = None
    ) -> DataFrame: ...


@dataclass(frozen=True)
class FrameReader:
    """Source tables that are already DataFrames: files, catalog tables, views.

    Spark splits such sources into tasks itself, by their size, so a requested
    split is not needed; ``RangeReader`` applies it.
    """

    frames: dict[str, DataFrame]

    def read(
        self, table: str, where: SourceFilter | None = None, split: Split | None = None
    ) -> DataFrame:
        df = self.frames[table]
        return df if where is None else df.where(where.condition())


@dataclass(frozen=True)
class RangeReader:
    """DataFrame sources read as the ranges of a split, one filtered scan per range.

    For sources that take a filter but give a single task by themselves. The ranges
    come from the same counts as those of a database, made here by Spark.
    """

    frames: dict[str, DataFrame]

    def read(
        self, table: str, where: SourceFilter | None = None, split: Split | None = None
    ) -> DataFrame:
        return reduce(DataFrame.unionAll, self.parts(table, where, split))

    def parts(
        self, table: str, where: SourceFilter | None = None, split: Split | None = None
    ) -> list[DataFrame]:
        """The rows of each range by themselves."""
        df = FrameReader(self.frames).read(table, where)
        if split is None:
            return [df]
        return [df.where(r.sql(f"`{split.column}`")) for r in self.ranges(df, split)]

    @staticmethod
    def ranges(df: DataFrame, split: Split) -> list[Range]:
        column = F.col(split.column)
        low, high = df.agg(F.min(column), F.max(column)).first()
        if low is None:
            return [Range(None, None)]

        def count_buckets(first: int, width: int, buckets: int) -> list[tuple[int, int]]:
            inside = df.where(Range(first, first + width * buckets).sql(f"`{split.column}`"))
            number = F.floor((column - F.lit(first)) / F.lit(width)).alias("bucket")
            return [tuple(row) for row in inside.groupBy(number).count().collect()]

        return balanced_ranges(low, high, split.tasks, count_buckets)


def parquet_reader(spark: SparkSession, root: str, tables: list[str]) -> FrameReader:
    """Source tables stored as ``<root>/<table>.parquet``."""
    return FrameReader({t: spark.read.parquet(f"{root}/{t}.parquet") for t in tables})


@dataclass(frozen=True)
class JdbcReader:
    """Source tables of a relational database.

    ``options`` are the options of Spark's JDBC source (``url``, ``driver``,
    ``user``, ``fetchsize`` ...). They are passed through and stored nowhere.
    Filters and column lists are pushed to the database by Spark.
    """

    spark: SparkSession
    options: dict[str, str]

    @property
    def _quote(self) -> str:
        return "`" if self.options["url"].startswith(("jdbc:mysql", "jdbc:mariadb")) else '"'

    def _load(self, dbtable: str, **extra: str) -> DataFrame:
        return (
            self.spark.read.format("jdbc")
            .options(**self.options, **extra)
            .option("dbtable", dbtable)
            .load()
        )

    def _bounds(self, table: str, where: SourceFilter | None, column: str) -> tuple:
        """Smallest and largest split value, computed by the database."""
        quoted = f"{self._quote}{column}{self._quote}"
        condition = f" WHERE {where.sql(self._quote)}" if where else ""
        query = f"SELECT MIN({quoted}) AS low, MAX({quoted}) AS high FROM {table}{condition}"
        return tuple(self._load(f"({query}) bounds").first())

    def _ranges(self, table: str, where: SourceFilter | None, split: Split) -> list[Range]:
        """Ranges of the split column with equal numbers of rows, counted by the database."""
        low, high = self._bounds(table, where, split.column)
        if low is None:
            return [Range(None, None)]
        column = f"{self._quote}{split.column}{self._quote}"
        also = f" AND {where.sql(self._quote)}" if where else ""

        def count_buckets(first: int, width: int, buckets: int) -> list[tuple[int, int]]:
            number = f"FLOOR(({column} - {first}) / {width})"
            query = (
                f"SELECT bucket, COUNT(*) AS n FROM (SELECT {number} AS bucket FROM {table} WHERE "
                f"{Range(first, first + width * buckets).sql(column)}{also}) numbered GROUP BY bucket"
            )
            return [(int(row[0]), int(row[1])) for row in self._load(f"({query}) counted").collect()]

        return balanced_ranges(int(low), int(high), split.tasks, count_buckets)

    def read(
        self, table: str, where: SourceFilter | None = None, split: Split | None = None
    ) -> DataFrame:
        if split is None:
            df = self._load(table)
        else:
            column = f"{self._quote}{split.column}{self._quote}"
            ranges = self._ranges(table, where, split)
            options = {k: v for k, v in self.options.items() if k != "url"}
            df = self.spark.read.jdbc(
                self.options["url"], table,
                predicates=[r.sql(column) for r in ranges], properties=options,
            )
        return df if where is None else df.where(where.condition())


@dataclass(frozen=True)
class RebasingReader:
    """A reader whose ``orders`` dates are moved into the present.

    A filter on a moved date is translated back to the source's own dates, so
    it is still applied by the source.
    """

    reader: Reader
    anchor: date

    def read(
        self, table: str, where: SourceFilter | None = None, split: Split | None = None
    ) -> DataFrame:
        if table != "orders":
            return self.reader.read(table, where, split)
        if where is None or where.column != "order_date":
            return rebase_order_dates(self.reader.read(table, where, split), self.anchor)
        if where.operator != "in":
            raise ValueError("only equality on a rebased date can be pushed to the source")
        wanted = [
            day.isoformat() if isinstance(value, str) else day
            for value in where.values
            for day in source_days(date.fromisoformat(str(value)), self.anchor)
        ]
        if not wanted:
            # A day whose own source date has been moved away and that no other
            # date was moved to: nothing can match.
            empty = self.reader.read(table, where).where(F.lit(False))
            return rebase_order_dates(empty, self.anchor)
        moved = replace(where, values=tuple(wanted))
        return rebase_order_dates(self.reader.read(table, moved, split), self.anchor)
