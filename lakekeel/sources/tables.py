"""Keyed lake tables on plain files, and catalog registration."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakekeel.operators.changes import DELETED, ORDER_TYPE, SEQ
from lakekeel.operators.joins import any_null
from lakekeel.operators.project import conformed
from lakekeel.operators.upsert import latest_per_key, upsert
from lakekeel.schemas import column_names
from lakekeel.sources.files import EVERY_AGE, children, path_exists, remove, size_of, touch
from lakekeel.sources.hashed import PART, PARTS

FIRST = "_first_seq"
_FOLDER = re.compile(r"(base|merge|change)-(\d+)(?:-(.+))?")


class LakeTable:
    """A keyed table: one compacted base folder plus the change batches written since.

    A batch is written to its own folder and never rewrites the table, so its cost
    is that of the batch; readers merge base and batches by key, newest first. A
    batch sent twice replaces itself, and a folder counts once its job committed,
    so a lost executor or a restarted driver leaves no half-applied batch. ``fmt``
    is any file format whose commit leaves ``_SUCCESS`` (Parquet, ORC). One driver
    writes a table at a time. Formats with their own MERGE use ``merge_into``.

    With ``hash_by``, a column, a base lies in ``parts`` partitions by its hash, and
    a look-up that names values of it reads only theirs.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str,
        keys: Sequence[str],
        order_by: Sequence[str] = (SEQ,),
        insert_only: Sequence[str] = (),
        fmt: str = "parquet",
        partition_by: Sequence[str] = (),
        hash_by: str | None = None,
        parts: int = PARTS,
    ):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self.columns = column_names(schema)
        self.keys, self.order_by = list(keys), list(order_by)
        self.partition_by = [PART] if hash_by else list(partition_by)
        self.hash_by, self.parts = hash_by, parts
        self.insert_only = [*insert_only, FIRST] if insert_only else []
        extra = [f"{c} {ORDER_TYPE}" for c in [*order_by, *([FIRST] if insert_only else [])]]
        self.stored_schema = ", ".join([schema.strip(), *extra, f"{DELETED} boolean"])

    def _folders(self) -> list[tuple[str, int, str | None, str]]:
        """(kind, generation, batch, name) of every folder, committed or not."""
        names = [_FOLDER.fullmatch(name) for name in children(self.spark, self.path)]
        return [(m[1], int(m[2]), m[3], m[0]) for m in names if m]

    def _done(self) -> list[tuple[str, int, str | None, str]]:
        return [f for f in self._folders() if path_exists(self.spark, f"{self.path}/{f[3]}/_SUCCESS")]

    def _committed(self) -> tuple[str | None, list[str]]:
        """The newest base folder and the folders of changes it does not contain."""
        done = self._done()
        base = max((f for f in done if f[0] == "base"), key=lambda f: f[1], default=None)
        since = base[1] if base else -1
        merged = max((f for f in done if f[0] == "merge" and f[1] > since), key=lambda f: f[1], default=None)
        pending = [f for f in done if f[0] == "change" and f[1] > (merged[1] if merged else since)]
        return base and base[3], [f[3] for f in ([merged] if merged else []) + pending]

    def exists(self) -> bool:
        base, changes = self._committed()
        return bool(base or changes)

    def size(self) -> int:
        """Bytes of the files a reader looks at."""
        base, changes = self._committed()
        return sum(size_of(self.spark, f"{self.path}/{name}") for name in [*([base] if base else []), *changes])

    def _read(self, names: list[str]) -> DataFrame:
        """Change folders together, or one base folder."""
        if not names:
            return self.spark.createDataFrame([], self.stored_schema)
        reader = self.spark.read.schema(self.stored_schema).format(self.fmt)
        return reader.load([f"{self.path}/{name}" for name in names])

    def _place(self) -> F.Column:
        return F.pmod(F.xxhash64(self.hash_by), F.lit(self.parts)).cast("int")

    def _base(self, name: str | None, within: DataFrame | None = None) -> DataFrame:
        """The base's rows; of those that ``within`` names only the partitions they can lie in."""
        if not name:
            return self._read([])
        hashed = self.hash_by and any(c.startswith(f"{PART}=") for c in children(self.spark, f"{self.path}/{name}"))
        if not hashed:
            return self._within(self._read([name]), within)
        rows = self.spark.read.schema(f"{self.stored_schema}, {PART} int").format(self.fmt).load(f"{self.path}/{name}")
        if within is not None and self.hash_by in within.columns:
            found = within.select(self._place().alias(PART)).distinct().collect()  # at most as many as there are parts
            rows = rows.filter(F.col(PART).isin([r[0] for r in found]))
        return self._within(rows, within).select(*column_names(self.stored_schema))

    def _write(self, rows: DataFrame, kind: str, generation: int, commit: bool = True) -> None:
        if kind == "base" and self.hash_by:
            rows = rows.withColumn(PART, self._place())
        if kind == "base" and self.partition_by:
            # Files of one size per partition value, however unevenly rows spread over the values.
            rows = rows.hint("rebalance", *map(F.col, self.partition_by))
            writer = rows.write.partitionBy(*self.partition_by)
        else:
            writer = rows.write
        # Without the mark of a committed job the folder doesn't count yet.
        writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(commit).lower())
        writer.format(self.fmt).mode("overwrite").save(f"{self.path}/{kind}-{generation:010d}")

    def _stored(self, rows: DataFrame) -> DataFrame:
        """Rows in the stored layout; those without an order are older than any change."""
        for column in self.order_by:
            if column not in rows.columns:
                rows = rows.withColumn(column, F.lit(-1))
        if self.insert_only and FIRST not in rows.columns:
            rows = rows.withColumn(FIRST, F.col(self.order_by[0]))
        if DELETED not in rows.columns:
            rows = rows.withColumn(DELETED, F.lit(False))
        return conformed(rows, self.stored_schema)

    def _latest(self, rows: DataFrame) -> DataFrame:
        first_by = FIRST if self.insert_only else None
        return latest_per_key(rows, self.keys, self.order_by, self.insert_only, first_by)

    def generation(self, batch: str) -> int:
        """The number a batch has or will get: it grows over all batches of the table, and a batch sent again keeps it."""
        sent = next((f[1] for f in self._done() if f[0] == "change" and f[2] == batch), None)
        return sent or max([f[1] for f in self._folders()], default=0) + 1

    def apply(self, changes: DataFrame, batch: str, resolved: bool = False) -> DataFrame:
        """Write one batch of changes and return its rows as written, one per key.

        ``resolved`` says the changes already hold one row per key.
        """
        done = self._done()
        compacted = max([f[1] for f in done if f[0] != "change"], default=-1)
        sent = next((f[1] for f in done if f[0] == "change" and f[2] == batch), None)
        generation = self.generation(batch)
        rows = self._stored(changes)
        rows = rows if resolved else self._latest(rows)
        if sent and sent <= compacted:
            return rows
        folder = f"change-{generation:010d}-{batch}"
        rows.write.format(self.fmt).mode("overwrite").save(f"{self.path}/{folder}")
        return self._read([folder])

    def history(self) -> DataFrame:
        """Every stored version since the last compaction, deletes included."""
        base, changes = self._committed()
        columns = column_names(self.stored_schema)
        return self._base(base).select(*columns).unionByName(self._read(changes))

    def _one_per_key(self, rows: DataFrame) -> DataFrame:
        """The newest row per key. NULL keys never meet, so those rows all stay."""
        return self._latest(rows.filter(~any_null(self.keys))).unionByName(rows.filter(any_null(self.keys)))

    def _newest(self, folders: list[str], within: DataFrame | None = None) -> DataFrame:
        rows = self._within(self._read(folders), within)
        return rows if len(folders) == 1 else self._one_per_key(rows)

    def _within(self, rows: DataFrame, within: DataFrame | None) -> DataFrame:
        return rows if within is None else rows.join(within, within.columns, "left_semi")

    def _merged(self, within: DataFrame | None = None) -> DataFrame:
        base, changes = self._committed()
        if not changes:
            return self._base(base, within)
        newest = self._newest(changes, within)
        if not base:
            return newest
        first_by = FIRST if self.insert_only else None
        stored = self._base(base, within).select(*newest.columns)
        return upsert(stored, newest, self.keys, self.insert_only, self.order_by, first_by)

    def versioned(self, within: DataFrame | None = None) -> DataFrame:
        """Current rows together with their order columns.

        ``within`` holds values of some key columns; other rows are left out before
        base and changes meet, so that a batch doesn't merge the whole table.
        """
        return self._merged(within).filter(~F.col(DELETED)).select(*self.columns, *self.order_by)

    def snapshot(self, within: DataFrame | None = None) -> DataFrame:
        """Current rows, without columns kept for the table's own use."""
        return self.versioned(within).select(*[c for c in self.columns if not c.startswith("_")])

    def repeats(self, rows: DataFrame) -> bool:
        """Whether a key without NULL occurs twice."""
        counts = rows.filter(~any_null(self.keys)).groupBy(*self.keys).count()
        return not counts.filter("count > 1").isEmpty()

    def replace(self, rows: DataFrame, resolved: bool = True) -> None:
        """Full refresh: the given rows become the table, unless ``resolved`` one per key.

        The base before stays until the next time, for readers still on it.
        """
        self.publish(self.stage(rows, resolved))

    def stage(self, rows: DataFrame, resolved: bool = True) -> int:
        """Write what :meth:`replace` would, without making it the table yet; returns its number."""
        stored = self._stored(rows)
        rows = stored if resolved else self._one_per_key(stored)
        generation = max([f[1] for f in self._folders()], default=0) + 1
        self._write(rows, "base", generation, commit=False)
        return generation

    def staged(self, generation: int) -> DataFrame:
        return self._base(f"base-{generation:010d}")

    def publish(self, generation: int) -> None:
        """Make a staged base the table."""
        earlier, _ = self._committed()
        touch(self.spark, f"{self.path}/base-{generation:010d}/_SUCCESS")
        for kind, number, _, name in self._folders():
            if kind == "base" and number < generation and name != earlier:
                remove(self.spark, f"{self.path}/{name}")

    def discard(self, generation: int) -> None:
        """Take a staged base away again."""
        remove(self.spark, f"{self.path}/base-{generation:010d}")

    def compact(self, after: int = 0, share: float = 0.25) -> bool:
        """Fold the changes together once they lie in more than ``after`` folders.

        They become a new base when they are at least ``share`` of its size, and one
        merged folder before that, so that the base is not rewritten for little.
        What an earlier compaction had already replaced is removed; what this one
        replaces stays until the next time, for readers still on it.
        """
        base, changes = self._committed()
        if len(changes) <= after:
            return False
        newest = int(_FOLDER.fullmatch(changes[-1])[2])
        replaced = max([f[1] for f in self._done() if f[0] != "change"], default=-1)
        pending = sum(size_of(self.spark, f"{self.path}/{name}") for name in changes)
        if base and pending < share * size_of(self.spark, f"{self.path}/{base}"):
            if len(changes) == 1:
                return False
            self._write(self._newest(changes), "merge", newest)
        else:
            self._write(self._merged(), "base", newest)
        for kind, generation, _, name in self._folders():
            if name != base and name not in changes and generation <= replaced:
                remove(self.spark, f"{self.path}/{name}")
        return True

    def change_stream(self, max_files: int | None = None) -> DataFrame:
        """The change batches as a stream; rewritten batches come again."""
        reader = self.spark.readStream.schema(self.stored_schema).format(self.fmt).option("maxFileAge", EVERY_AGE)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.load(f"{self.path}/change-*")


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def save_external(
    df: DataFrame,
    table: str,
    path: str,
    fmt: str = "parquet",
    bucket_by: tuple[int, str] | None = None,
) -> DataFrame:
    """Replace the content of an external catalog table and return the table.

    Each time writes a new folder under ``path`` and then points the table to it, so
    queries see the old or the new rows; the folder before the last one is removed.
    Tables bucketed on the same key and count join on it without a shuffle.
    """
    spark = df.sparkSession
    earlier = [name for name in children(spark, path) if name.startswith("v-")]
    number = int(earlier[-1][2:]) + 1 if earlier else 0
    folder = f"{path}/v-{number:010d}"
    if bucket_by:
        count, key = bucket_by
        writer = df.repartition(count, key).write.format(fmt).mode("overwrite").option("path", folder)
        writer.bucketBy(count, key).sortBy(key).saveAsTable(table)
    else:
        df.write.format(fmt).mode("overwrite").save(folder)
        if spark.catalog.tableExists(table) and spark.table(table).dtypes == df.dtypes:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            register_external(spark, table, folder, fmt)
    for name in earlier[:-1]:
        remove(spark, f"{path}/{name}")
    return spark.table(table)


def register_external(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {fmt} LOCATION '{path}'")
