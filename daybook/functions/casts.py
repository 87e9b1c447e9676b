"""Casts between model types and sink types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def cast_to_sink(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and with its types.

    A value that does not fit its column raises, also when ANSI mode is off.
    """
    return df.to(schema)


def cast_known(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` first, with its types, then all others as they are."""
    others = [field for field in df.schema if field.name not in schema.names]
    return df.to(T.StructType([*schema.fields, *others]))
