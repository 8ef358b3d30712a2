"""Renames, nested-field flattening and view casts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep exactly the mapped columns under their new names; a missing one is an error."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def flattened(document: str, fields: Mapping[str, str]) -> list[Column]:
    """Columns for paths inside a parsed struct; a missing parent gives NULL."""
    return [F.col(f"{document}.{path}").alias(name) for path, name in fields.items()]


def conformed(df: DataFrame, schema: str) -> DataFrame:
    """Columns of ``schema`` in its order, cast to its types."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema).fields]
    )
