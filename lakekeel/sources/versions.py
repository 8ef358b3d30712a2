"""Snapshots whose schema changes over time, read as one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lakekeel.sources.files import children, path_exists

#: Types that hold every value of the ones before them.
_WIDER = (
    (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    (T.ByteType, T.ShortType, T.IntegerType, T.DoubleType),
    (T.FloatType, T.DoubleType),
    (T.DateType, T.TimestampNTZType),
)


class SchemaConflict(ValueError):
    """A version's column can't hold what an earlier version has."""


def _whole_digits(kind: T.DataType) -> int | None:
    """Digits before the point that a whole number type needs."""
    return {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}.get(type(kind))


def _holds(wide: T.DataType, narrow: T.DataType) -> bool:
    if wide == narrow:
        return True
    if isinstance(wide, T.DecimalType):
        if isinstance(narrow, T.DecimalType):
            return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
        digits = _whole_digits(narrow)
        return digits is not None and wide.precision - wide.scale >= digits
    return any(type(narrow) in chain and type(wide) in chain[chain.index(type(narrow)) :] for chain in _WIDER)


def evolved(old: T.StructType, new: T.StructType) -> T.StructType:
    """The schema that reads both: columns in the order they came, each of the wider type.

    A new column is NULL in earlier rows and one that is gone in later ones. A
    column that became narrower, or of an unrelated type, is a conflict; so are
    names that differ in case only.
    """
    known = {f.name: f for f in old.fields}
    lowered = {f.name.lower(): f.name for f in old.fields}
    fields = []
    for field in old.fields:
        later = new[field.name] if field.name in new.names else None
        if later is not None and not _holds(later.dataType, field.dataType):
            raise SchemaConflict(f"{field.name}: {field.dataType.simpleString()} became {later.dataType.simpleString()}")
        fields.append(T.StructField(field.name, later.dataType if later is not None else field.dataType, True))
    for field in new.fields:
        if field.name not in known:
            if field.name.lower() in lowered:
                raise SchemaConflict(f"{field.name}: earlier versions call it {lowered[field.name.lower()]}")
            fields.append(T.StructField(field.name, field.dataType, True))
    return T.StructType(fields)


class VersionedSnapshots:
    """Generations of a table under one folder, each with the schema it came with.

    Nothing is rewritten when the schema grows: readers bring each generation to
    the common schema. A generation that can't be read along is refused before it is written.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _generations(self) -> list[str]:
        names = [n for n in children(self.spark, self.path) if n.startswith("v-")]
        return [n for n in names if path_exists(self.spark, f"{self.path}/{n}/_SUCCESS")]

    def _loaded(self) -> list[DataFrame]:
        return [self.spark.read.parquet(f"{self.path}/{name}") for name in self._generations()]

    def schema(self) -> T.StructType | None:
        found = None
        for frame in self._loaded():
            found = evolved(found, frame.schema) if found else frame.schema
        return found

    def add(self, rows: DataFrame) -> None:
        known = self.schema()
        if known:
            evolved(known, rows.schema)
        number = int(self._generations()[-1][2:]) + 1 if known else 0
        rows.write.mode("overwrite").parquet(f"{self.path}/v-{number:010d}")

    def read(self) -> DataFrame:
        """All generations' rows, with the number of theirs as ``_version``; filters and columns reach each one's files."""
        names, frames, schema = self._generations(), self._loaded(), self.schema()
        if not names:
            raise FileNotFoundError(f"no version under {self.path}")
        found = None
        for name, frame in zip(names, frames, strict=True):
            columns = [
                (F.col(f"`{f.name}`") if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
            ]
            rows = frame.select(*columns, F.lit(int(name[2:])).alias("_version"))
            found = found.unionByName(rows) if found is not None else rows
        return found
