"""Change-data-capture envelopes: parsing, typing, accepted and rejected messages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from lakekeel.functions.temporal import as_date, as_instant

# Operations that carry a new row state, and the one that removes a row.
STATE_OPS = ("c", "u", "r")
DELETE_OP = "d"

# Columns added to every parsed change.
OP, SEQ, DELETED = "op", "_seq", "_deleted"

#: What a change says about its order, by rank: the number of its batch, its offset in the topic, its event time, its
#: position in the source's log. Only changes of one rank compare by their numbers; a higher rank is newer.
BY_BATCH, BY_OFFSET, BY_TIME, BY_LOG = range(4)
#: Type of an order vector, and its shares of 126 bits: rank, position, and what decides between equal positions.
ORDER_TYPE = "decimal(38,0)"
_POSITION_BITS, _TIE_BITS = 63, 61


def order_vector(rank: int, position: Column, tie: Column | None = None) -> Column:
    """(rank, position, tie) as one decimal of the same order; NULL where there is no position.

    A decimal, unlike a struct, is aggregated by hash. Positions lie between
    -2^62 and 2^62, ties between 0 and 2^61; values beyond count as the nearest.
    """
    whole = lambda value: F.lit(str(value)).cast(ORDER_TYPE)
    half = 1 << (_POSITION_BITS - 1)
    bounded = F.least(F.greatest(position.cast("bigint"), F.lit(-half)), F.lit(half - 1)).cast("decimal(20,0)") + F.lit(half).cast("decimal(20,0)")
    last = F.least(F.greatest(F.coalesce(tie, F.lit(0)).cast("bigint"), F.lit(0)), F.lit((1 << _TIE_BITS) - 1)) if tie is not None else F.lit(0)
    high = (bounded * F.lit(str(1 << _TIE_BITS)).cast("decimal(19,0)")).cast(ORDER_TYPE)
    number = whole(rank << (_POSITION_BITS + _TIE_BITS)) + high.cast(ORDER_TYPE)
    return F.when(position.isNotNull(), (number.cast(ORDER_TYPE) + last.cast(ORDER_TYPE)).cast(ORDER_TYPE))


def _from_wire(column: Column, dtype: T.DataType) -> Column:
    """A value from its JSON text, NULL if it isn't of its type: dates travel as epoch days, instants as text."""
    if isinstance(dtype, T.DateType):
        return as_date(column.try_cast("bigint"), T.LongType())
    if isinstance(dtype, T.TimestampType):
        return as_instant(column, T.StringType())
    return column if isinstance(dtype, T.StringType) else column.try_cast(dtype)


def parse_changes(
    raw: DataFrame, table_schema: str, keys: Sequence[str] = (), ordered: bool = False, deletes: bool = True
) -> DataFrame:
    """Typed rows of a topic's ``value`` column, batch or streaming.

    The record may sit under ``payload`` or stand bare; the JSON is parsed once.
    Adds ``op``, ``_seq``, ``_deleted`` and ``_reason``, which is NULL for a readable
    message. ``_seq`` is the source log position, else the event time, else the
    topic's ``position`` where it has one. Deletes take their row from ``before``.
    Messages without a value are skipped.

    With ``ordered`` ``_seq`` is an :func:`order_vector` instead, so that changes of
    several kinds of position compare: by log position, then event time, then
    offset; of equal log positions or times the later offset is newer, else the
    later event time. A change without a value in one of ``keys`` is no readable
    one; of ``deletes`` that are not wanted that isn't asked.
    """
    fields = T.StructType.fromDDL(table_schema).fields
    row = ", ".join(f"{f.name} string" for f in fields)  # as text, so that a wrong type is seen and not lost
    record = (
        f"op string, before struct<{row}>, after struct<{row}>, "
        "source struct<lsn bigint>, ts_ms bigint"
    )
    # A one-row inline keeps later filters from repeating the JSON parse.
    text = F.col("value").cast("string")
    arrival = F.col("position") if "position" in raw.columns else F.lit(None).cast("bigint")
    parsed = raw.filter(F.col("value").isNotNull()).select(
        text.alias("_value"), arrival.alias("_arrival"), F.inline(F.array(F.from_json(text, f"payload struct<{record}>, {record}")))
    )

    def part(name: str) -> Column:
        return F.when(F.col("payload").isNotNull(), F.col(f"payload.{name}")).otherwise(F.col(name))

    image = F.when(part("op") == DELETE_OP, part("before")).otherwise(part("after"))
    log, time, offset = part("source")["lsn"], part("ts_ms"), F.col("_arrival")
    if ordered:
        later = F.coalesce(offset, time)
        position = F.coalesce(order_vector(BY_LOG, log, later), order_vector(BY_TIME, time, offset), order_vector(BY_OFFSET, offset))
    else:
        position = F.coalesce(log, time, offset)
    messages = parsed.select(
        "_value",
        F.inline(F.array(F.struct(part("op").alias(OP), image.alias("_row"), position.alias(SEQ)))),
    )
    # A second one-row inline, so that the reason and the values share one conversion.
    typed = [_from_wire(F.col(f"_row.{f.name}"), f.dataType).alias(f.name) for f in fields]
    messages = messages.select("_value", OP, "_row", SEQ, F.inline(F.array(F.struct(*typed))))
    empty = reduce(lambda a, b: a & b, [F.col(f"_row.{f.name}").isNull() for f in fields])
    reason = (
        F.when(F.col(OP).isNull(), "no operation")
        .when(~F.col(OP).isin(*STATE_OPS, DELETE_OP), "unknown operation")
        .when((F.col(OP) != DELETE_OP) & empty, "no row image")
    )
    for f in fields:
        if not isinstance(f.dataType, T.StringType):
            unreadable = F.col(f"_row.{f.name}").isNotNull() & F.col(f.name).isNull()
            reason = reason.when(unreadable, f"unreadable {f.name}")
    if keys:
        wanted = F.lit(True) if deletes else F.col(OP) != DELETE_OP
        reason = reason.when(wanted & reduce(lambda a, b: a | b, [F.col(f"_row.{k}").isNull() for k in keys]), "no key")
    return messages.select(
        OP,
        *[f.name for f in fields],
        SEQ,
        (F.col(OP) == DELETE_OP).alias(DELETED),
        reason.alias("_reason"),
        "_value",
    )


def accepted(parsed: DataFrame, apply_deletes: bool = False) -> DataFrame:
    """Readable changes; deletes only on request."""
    ops = (*STATE_OPS, DELETE_OP) if apply_deletes else STATE_OPS
    return parsed.filter(F.col("_reason").isNull() & F.col(OP).isin(*ops)).drop("_reason", "_value")


def rejected(parsed: DataFrame) -> DataFrame:
    """Messages that cannot be applied, as they came, with the reason."""
    return parsed.filter(F.col("_reason").isNotNull()).select(
        F.col("_value").alias("value"), F.col("_reason").alias("reason")
    )


def inserts(parsed: DataFrame) -> DataFrame:
    """Only newly created rows."""
    return parsed.filter(F.col("_reason").isNull() & (F.col(OP) == "c")).drop("_reason", "_value")
