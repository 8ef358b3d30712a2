"""Append-only logs laid out by a hash of their key, so that a batch reads only the folders its keys lie in."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakekeel.schemas import column_names
from lakekeel.sources.files import children, path_exists, remove, touch

#: Columns that say where a row lies.
PART, BATCH = "_part", "_batch"
#: Hash folders by default, enough for some 2 GB; at most as many values are ever brought to the driver.
PARTS = 16
_GENERATION = re.compile(r"g-(\d+)")


class HashedLog:
    """Rows appended batch by batch to partitions ``_part=<hash of the key>/_batch=<number>``.

    Plain partitioned files: a batch sent again overwrites its own partitions
    (dynamic partition overwrite), and a reader that names its keys gets
    partition filters, so what it reads follows from the keys and not from the
    log. ``parts`` is part of the layout and stays as it was for a folder; take
    it from the size the log is going to have, some 128 MB a part. Key values
    aren't NULL. ``fold`` starts a new generation with few files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: Sequence[str], parts: int = PARTS):
        self.spark, self.path, self.key, self.parts = spark, path.rstrip("/"), list(key), parts
        self.columns = column_names(schema)
        self.stored_schema = f"{schema}, {PART} int, {BATCH} bigint"

    def _generations(self) -> list[int]:
        found = [_GENERATION.fullmatch(name) for name in children(self.spark, self.path)]
        return sorted(int(m[1]) for m in found if m and path_exists(self.spark, f"{self.path}/{m[0]}/_SUCCESS"))

    def _folder(self) -> str:
        return f"{self.path}/g-{(self._generations() or [0])[-1]:06d}"

    def exists(self) -> bool:
        return bool(self._generations())

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(PART, F.pmod(F.xxhash64(*self.key), F.lit(self.parts)).cast("int"))

    def _write(self, rows: DataFrame, folder: str) -> None:
        # Adaptive execution makes files of even size of a part, however many rows its keys have.
        rows = rows.select(*self.columns, PART, BATCH).hint("rebalance", PART)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART, BATCH).parquet(folder)
        if not path_exists(self.spark, f"{folder}/_SUCCESS"):  # which a dynamic overwrite doesn't leave
            touch(self.spark, f"{folder}/_SUCCESS")

    def append(self, rows: DataFrame, batch: int) -> None:
        """Write a batch; the same batch again replaces what it had written."""
        self._write(self._placed(rows).withColumn(BATCH, F.lit(batch).cast("bigint")), self._folder())

    def replace(self, rows: DataFrame, batch: int = 0) -> None:
        """A new generation that holds the given rows alone."""
        self._next(self._placed(rows).withColumn(BATCH, F.lit(batch).cast("bigint")))

    def _next(self, rows: DataFrame) -> None:
        earlier = self._generations()
        self._write(rows, f"{self.path}/g-{(earlier or [0])[-1] + 1:06d}")
        for number in earlier[:-1]:  # the one before stays for readers still on it
            remove(self.spark, f"{self.path}/g-{number:06d}")

    def read(self, keys: DataFrame | None = None, before: int | None = None, batch: int | None = None) -> DataFrame:
        """Rows with their place: all, those of some keys, those of earlier batches or of one batch.

        ``keys`` holds values of the key columns; the numbers of their parts
        become a filter on the partitions, and the keys themselves a semi join.
        """
        if not self.exists():
            return self.spark.createDataFrame([], self.stored_schema)
        rows = self.spark.read.schema(self.stored_schema).parquet(self._folder())
        if before is not None:
            rows = rows.filter(F.col(BATCH) < before)
        if batch is not None:
            rows = rows.filter(F.col(BATCH) == batch)
        if keys is not None:
            found = self._placed(keys.select(*self.key)).select(PART).distinct().collect()
            rows = rows.filter(F.col(PART).isin([r[0] for r in found])).join(keys.select(*self.key), self.key, "left_semi")
        return rows

    def beside(self, rows: DataFrame, before: int | None = None) -> DataFrame:
        """Rows of the parts in which the keys of ``rows`` lie: a superset of theirs, for callers that join or group by key anyway."""
        found = self.read(before=before)
        if not self.exists():
            return found
        parts = self._placed(rows.select(*self.key)).select(PART).distinct().collect()  # at most as many as there are parts
        return found.filter(F.col(PART).isin([r[0] for r in parts]))

    def fold(self, summary: Callable[[DataFrame], DataFrame], after: int = 16) -> bool:
        """Once there are more than ``after`` batches, write what ``summary`` makes of all but the last as one batch.

        The last one stays apart, since its stream may send it again.
        """
        if not self.exists():
            return False
        batches = sorted(r[0] for r in self.read().select(BATCH).distinct().collect())
        if len(batches) <= after:
            return False
        rows = self.read()
        early = summary(rows.filter(F.col(BATCH) < batches[-1])).withColumn(BATCH, F.lit(batches[-2]).cast("bigint"))
        self._next(self._placed(early).select(*self.columns, PART, BATCH).unionByName(rows.filter(F.col(BATCH) == batches[-1])))
        return True
