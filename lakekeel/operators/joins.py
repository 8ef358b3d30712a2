"""Joins against dimensions: broadcast by measured size, otherwise shuffled and split where skewed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType


def broadcast_limit(df: DataFrame) -> int:
    """The session's ``autoBroadcastJoinThreshold`` in bytes."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()
    if text.lstrip("-").isdigit():
        return int(text)
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def _row_bytes(df: DataFrame) -> Column:
    """Upper bound of a row's size in a join: 16 bytes and 16 a column, texts by length, nested values by their JSON."""
    size = F.lit(16 + 16 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            size += F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            size += F.coalesce(F.octet_length(F.to_json(F.struct(value))) * 16, F.lit(0))
    return size


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate. It counts files as they are compressed, so it can be far too small."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(_row_bytes(df))).first()[0] or 0


def fits_broadcast(df: DataFrame) -> bool:
    """Whether all rows, measured, are within the broadcast threshold.

    Rows are read for it only if the optimizer's estimate is within it already.
    """
    limit = broadcast_limit(df)
    return estimated_bytes(df) <= limit and measured_bytes(df) <= limit


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])


def lookup_join(facts: DataFrame, dimension: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of facts with a dimension that is unique on ``keys``; facts are read once.

    A dimension that measures small enough is broadcast. Another one is shuffled,
    and adaptive execution splits the fact rows of a hot or NULL key over several
    tasks. Where the estimate is small but the rows are not, the hint keeps the
    planner from trusting the estimate.
    """
    if estimated_bytes(dimension) > broadcast_limit(dimension):
        return facts.join(dimension, keys, "left")
    return facts.join(F.broadcast(dimension) if fits_broadcast(dimension) else dimension.hint("merge"), keys, "left")


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent and how many child rows carry each.

    Child rows are counted per value before the join, so a value shared by many
    rows meets the parent table as one row. NULL references are allowed.
    """
    references = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(
        F.count("*").alias("child_rows")
    )
    parents = parent.select(F.col(parent_key).alias(foreign_key))
    return references.join(parents, foreign_key, "left_anti")
