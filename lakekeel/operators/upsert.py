"""Keyed upserts as pure DataFrame functions, and the MERGE statement for table formats."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lakekeel.operators.joins import any_null, fits_broadcast


def latest_per_key(
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    insert_only: Sequence[str] = (),
    first_by: str | None = None,
) -> DataFrame:
    """The newest row per key by ``order_by``; the remaining columns break exact ties.

    ``insert_only`` columns come from the oldest row by ``first_by`` instead. One
    aggregate with map-side combine: a key with very many changes leaves each map
    task as one row. NULL keys form one group, as in a de-duplication.
    """
    rest = [c for c in changes.columns if c not in keys and c not in order_by]
    aggregates = [F.max(F.struct(*order_by, *rest)).alias("_newest")]
    if insert_only:
        aggregates.append(F.min(F.struct(first_by, *[c for c in insert_only if c != first_by])).alias("_oldest"))

    def value(column: str) -> Column:
        if column in keys:
            return F.col(column)
        return F.col(f"{'_oldest' if column in insert_only else '_newest'}.{column}").alias(column)

    return changes.groupBy(*keys).agg(*aggregates).select(*[value(c) for c in changes.columns])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    insert_only: Sequence[str] = (),
    order_by: Sequence[str] = (),
    first_by: str | None = None,
) -> DataFrame:
    """Target after updating matched rows from source and inserting the unmatched ones.

    ``source`` holds one row per key. ``insert_only`` columns keep the target's
    value on a match, unless ``first_by`` says the source row is the older one.
    With ``order_by`` a source row older than its target row changes nothing else.
    NULL keys never match, so such source rows are inserted.

    A source of broadcastable size updates the target without shuffling it; a
    larger one meets it in a single full outer join.
    """
    keys = list(keys)
    source = source.select(*target.columns)
    values = [c for c in target.columns if c not in keys]
    old = target.withColumn("_in_target", F.lit(True))
    new = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_in_source"))
    takes_new = F.col("_in_source").isNotNull()
    if order_by:
        takes_new &= F.struct(*[F.col(f"_new_{c}") for c in order_by]) >= F.struct(*order_by)
    starts_earlier = F.lit(False)
    if first_by:
        starts_earlier = F.coalesce(F.col(f"_new_{first_by}") < F.col(first_by), F.lit(False))

    def merged(column: str) -> Column:
        if column in keys:
            return F.col(column)
        wins = F.col("_in_target").isNull() | (starts_earlier if column in insert_only else takes_new)
        return F.when(wins, F.col(f"_new_{column}")).otherwise(F.col(column)).alias(column)

    columns = [merged(c) for c in target.columns]
    if not fits_broadcast(source):
        # Rows with a NULL key meet nothing, so they need not travel to one task.
        keyed = ~any_null(keys)
        merged_rows = old.filter(keyed).join(new.filter(keyed), keys, "full_outer").select(*columns)
        return merged_rows.unionByName(target.filter(~keyed)).unionByName(source.filter(~keyed))
    updated = old.join(F.broadcast(new), keys, "left").select(*columns)
    matched = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi")
    return updated.unionByName(source.join(matched, keys, "left_anti"))


def merge_statement(
    table: str,
    source_view: str,
    keys: Sequence[str],
    columns: Sequence[str],
    insert_only: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> str:
    """``MERGE INTO`` with the same meaning as :func:`upsert`, for formats that support it.

    With ``order_by`` a source row older than its target row changes nothing.
    """
    rank = lambda side: ", ".join(f"{side}.`{c}`" for c in order_by)
    newer = f"AND struct({rank('s')}) >= struct({rank('t')}) " if order_by else ""
    match = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns if c not in insert_only)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    return (
        f"MERGE INTO {table} t USING {source_view} s ON {match} "
        f"WHEN MATCHED {newer}THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def merge_into(
    source: DataFrame, table: str, keys: Sequence[str], insert_only: Sequence[str] = (), order_by: Sequence[str] = ()
) -> None:
    """Run :func:`merge_statement` on a catalog table whose format supports MERGE; ``source`` may hold several rows of a key."""
    newest = latest_per_key(source, keys, order_by) if order_by else source
    view = f"lakekeel_merge_{uuid.uuid4().hex}"
    newest.createOrReplaceTempView(view)
    try:
        source.sparkSession.sql(merge_statement(table, view, keys, source.columns, insert_only, order_by))
    finally:
        source.sparkSession.catalog.dropTempView(view)
