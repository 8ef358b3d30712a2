"""Key checks that look at the keys a batch touches: duplicates and references without a parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakekeel.sources.hashed import PARTS, HashedLog

#: Rows of a key so far: as a key of its own table (``parents``) and as a reference from another (``children``).
_COUNTS = "key string, parents bigint, children bigint"


class KeyChecks:
    """Uniqueness of a key and the references to it, kept up to date batch by batch.

    ``counts`` logs how many rows of either side a batch brought or took for a
    key, by the key's hash; ``totals`` how the numbers of bad keys and rows
    changed. A batch reads the counts of its own keys only, whatever the tables
    have grown to, and a batch sent again replaces what it had logged. NULL keys
    refer to nothing and aren't unique; they take no part.
    """

    def __init__(self, spark: SparkSession, root: str, parts: int = PARTS):
        self.counts = HashedLog(spark, f"{root}/counts", _COUNTS, ["key"], parts)
        self.totals = HashedLog(spark, f"{root}/totals", "check_name string, change bigint", ["check_name"], 1)

    def apply(self, batch: int, parents: DataFrame | None = None, children: DataFrame | None = None) -> DataFrame:
        """Log a batch of keys ``(key, n)``: n rows more, or fewer where negative. Returns the keys that are bad now.

        ``check_name``, ``key``, ``rows``: a key that several parents have, or one that children have and no parent.
        """
        sides = [
            side.filter("key IS NOT NULL").select(F.col("key").cast("string").alias("key"), *(F.col("n").cast("bigint").alias(c) if c == own else F.lit(0).cast("bigint").alias(c) for c in ("parents", "children")))
            for side, own in ((parents, "parents"), (children, "children")) if side is not None
        ]
        rows = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
        self.counts.append(rows.groupBy("key").agg(F.sum("parents").alias("parents"), F.sum("children").alias("children")), batch)
        touched = self.counts.read(batch=batch).select("key")
        held = self.counts.read(touched).filter(F.col("_batch") <= batch)
        now = lambda column: F.sum(column)
        earlier = lambda column: F.sum(F.when(F.col("_batch") < batch, F.col(column)).otherwise(0))
        both = held.groupBy("key").agg(
            now("parents").alias("parents"), now("children").alias("children"), earlier("parents").alias("parents_before"), earlier("children").alias("children_before"),
        )
        judged = both.select("key", F.inline(F.array(
            _judged("unique", _repeated(F.col("parents")), _repeated(F.col("parents_before")), F.col("parents")),
            _judged("references", _orphaned("parents", "children"), _orphaned("parents_before", "children_before"), F.col("children")),
        )))
        changes = judged.groupBy("check_name").agg(F.sum(F.col("bad") - F.col("bad_before")).alias("change"))
        self.totals.append(changes, batch)
        return judged.filter("bad > 0").select("check_name", "key", "rows")

    def report(self) -> DataFrame:
        """``check_name, measured, passed``: repeated keys, and child rows without a parent."""
        found = self.totals.read().groupBy("check_name").agg(F.sum("change").alias("measured"))
        return found.select("check_name", "measured", (F.col("measured") == 0).alias("passed"))


def _repeated(rows: Column) -> Column:
    return (rows > 1).cast("bigint")


def _orphaned(parents: str, children: str) -> Column:
    return F.when(F.col(parents) <= 0, F.greatest(F.col(children), F.lit(0))).otherwise(0).cast("bigint")


def _judged(name: str, bad: Column, before: Column, rows: Column) -> Column:
    return F.struct(F.lit(name).alias("check_name"), bad.alias("bad"), before.alias("bad_before"), rows.alias("rows"))


def key_counts(rows: DataFrame, column: str, sign: int = 1) -> DataFrame:
    """``(key, n)`` of a batch for :class:`KeyChecks`: its rows of each key, before anything is shuffled by it."""
    return rows.groupBy(F.col(column).alias("key")).agg((F.count("*") * sign).alias("n"))
