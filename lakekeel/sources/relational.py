"""Operational database tables over JDBC (the driver jar comes with the cluster)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

#: A whole number from a text, in the database's SQL.
HASH = "hashtext({})"


def range_predicates(column: str, bounds: Sequence[int]) -> list[str]:
    """Conditions that cut a numeric key at its rising bounds, the greatest values of all ranges but the last.

    Every row meets exactly one; rows without a key meet the first. Bounds that
    repeat, as of a key with very many rows, make no empty range.
    """
    cuts = sorted(set(bounds))
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [f"{column} <= {cuts[0]} OR {column} IS NULL", *between, f"{column} > {cuts[-1]}"]


def hash_predicates(columns: Sequence[str], partitions: int, hash_sql: str = HASH) -> list[str]:
    """Conditions that deal rows out by a hash of textual keys; every row meets exactly one, NULL keys included."""
    if partitions < 2:
        return ["1 = 1"]
    text = " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in columns)
    # The sign bit is cut off instead of taking the absolute value, which the least number doesn't have.
    number = f"CAST({hash_sql.format(text)} & 2147483647 AS BIGINT) % {partitions}"
    return [f"{number} = {i}" for i in range(partitions)]


def quantile_query(table: str, column: str, partitions: int) -> str:
    """The greatest key of each of so many equally large ranges of rows, but the last."""
    return (
        f"SELECT bound FROM (SELECT part, MAX({column}) AS bound FROM (SELECT {column}, NTILE({partitions}) OVER (ORDER BY {column}) AS part "
        f"FROM {table} WHERE {column} IS NOT NULL) AS ranked GROUP BY part) AS cut WHERE part < {partitions}"
    )


@dataclass(frozen=True)
class Database:
    """Connection of one database and how its snapshot scans split."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000

    def read(
        self,
        spark: SparkSession,
        table: str,
        split_on: str | None = None,
        bounds: tuple[int, int] | None = None,
        partitions: int = 1,
    ) -> DataFrame:
        """Snapshot of a table; with ``split_on`` the scan runs as parallel key ranges.

        Without ``bounds`` the table is asked for its least and largest key. Rows
        outside the bounds or without a key are read all the same. Filters and the
        column selection of the caller reach the database.
        """
        options = {"url": self.url, "dbtable": table, "fetchsize": str(self.fetch_size), **self.properties}
        if split_on and partitions > 1:
            bounds = bounds or self.bounds(spark, table, split_on)
        if split_on and partitions > 1 and bounds:
            options |= {
                "partitionColumn": split_on,
                "lowerBound": str(bounds[0]),
                "upperBound": str(bounds[1]),
                "numPartitions": str(partitions),
            }
        return spark.read.format("jdbc").options(**options).load()

    def bounds(self, spark: SparkSession, table: str, column: str) -> tuple[int, int] | None:
        """Least and largest value of a column; None for a table without any."""
        wanted = f"SELECT min({column}) AS low, max({column}) AS high FROM {table}"
        row = spark.read.format("jdbc").options(url=self.url, query=wanted, **self.properties).load().first()
        return None if row[0] is None else (row[0], row[1])

    def quantiles(self, spark: SparkSession, table: str, column: str, partitions: int) -> list[int]:
        """Bounds of ranges with equally many rows each, computed by the database."""
        wanted = quantile_query(table, column, partitions)
        rows = spark.read.format("jdbc").options(url=self.url, query=wanted, **self.properties).load().collect()
        return [int(r[0]) for r in rows]

    def read_split(self, spark: SparkSession, table: str, predicates: Sequence[str]) -> DataFrame:
        """Snapshot of a table by one task for each condition; the conditions have each row exactly once."""
        if len(predicates) < 2:
            return self.read(spark, table)
        properties = {"fetchsize": str(self.fetch_size), **self.properties}
        return spark.read.jdbc(self.url, table, predicates=list(predicates), properties=properties)

    def append(self, df: DataFrame, table: str) -> None:
        options = {"url": self.url, "dbtable": table, **self.properties}
        df.write.format("jdbc").options(**options).mode("append").save()
