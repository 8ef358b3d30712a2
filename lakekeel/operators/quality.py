"""Data-quality reports as DataFrames: one scan for all row checks of a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lakekeel.operators.joins import orphans


@dataclass(frozen=True)
class RowCheck:
    """A SQL condition rows should meet. A NULL outcome is not a failure."""

    name: str
    condition: str


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not null {column}", f"{column} IS NOT NULL")


def _outcome(table: str, check: str, measured: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        measured.cast("bigint").alias("measured"),
        passed.alias("passed"),
    )


def duplicated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys occurring more than once, the NULL key included, and how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def report(
    df: DataFrame,
    table: str,
    row_checks: Sequence[RowCheck] = (),
    unique: Sequence[Sequence[str]] = (),
    min_rows: int = 1,
) -> DataFrame:
    """table_name, check_name, measured, passed - one row per check.

    ``measured`` is the row count for the volume check, the failing rows for a row
    check and the duplicated keys for a uniqueness check.
    """
    failing = [F.count_if(F.expr(f"NOT ({c.condition})")).alias(f"c{i}") for i, c in enumerate(row_checks)]
    totals = df.agg(F.count("*").alias("n"), *failing)
    outcomes = [_outcome(table, "volume", F.col("n"), F.col("n") >= min_rows)] + [
        _outcome(table, c.name, F.col(f"c{i}"), F.col(f"c{i}") == 0) for i, c in enumerate(row_checks)
    ]
    result = totals.select(F.inline(F.array(*outcomes)))
    for keys in unique:
        duplicates = duplicated_keys(df, *keys).agg(F.count("*").alias("n"))
        outcome = _outcome(table, f"unique {', '.join(keys)}", F.col("n"), F.col("n") == 0)
        result = result.unionByName(duplicates.select(F.inline(F.array(outcome))))
    return result


class Observed:
    """Volume and row checks of a table, measured by the job that writes it instead of a scan of their own.

    ``attach`` before the write, ``outcomes`` after it, once.
    """

    def __init__(self, table: str, row_checks: Sequence[RowCheck] = (), min_rows: int = 1):
        self.table, self.row_checks, self.min_rows = table, list(row_checks), min_rows
        self.observation = Observation(f"checks of {table}")

    def attach(self, rows: DataFrame) -> DataFrame:
        failing = [F.count_if(F.expr(f"NOT ({c.condition})")).alias(f"c{i}") for i, c in enumerate(self.row_checks)]
        return rows.observe(self.observation, F.count(F.lit(1)).alias("n"), *failing)

    def outcomes(self) -> list[tuple[str, str, int, bool]]:
        """(table, check, measured, passed) as in :func:`report`."""
        found = self.observation.get
        return [(self.table, "volume", found["n"], found["n"] >= self.min_rows)] + [
            (self.table, c.name, found[f"c{i}"], found[f"c{i}"] == 0) for i, c in enumerate(self.row_checks)
        ]


def key_conflicts(rows: DataFrame, stored: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Keys of new rows that a key constraint refuses, each once with its ``problem``: missing, repeated, present.

    Rows are counted per key before they meet the stored table, of which only the key columns are read.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    problem = F.when(missing, "missing").when(F.col("_n") > 1, "repeated")
    found = counts.withColumn("problem", problem)
    if stored is not None:
        known = stored.select(*keys).distinct().withColumn("_known", F.lit(True))
        found = found.join(known, list(keys), "left").withColumn("problem", F.coalesce("problem", F.when(F.col("_known"), "present")))
    return found.filter("problem IS NOT NULL").select(*keys, "problem")


def require_new_keys(rows: DataFrame, stored: DataFrame | None, keys: Sequence[str], table: str) -> None:
    """Raise with some of the refused keys, before anything is written."""
    bad = key_conflicts(rows, stored, keys).limit(5).collect()
    if bad:
        listed = "; ".join(f"{', '.join(str(r[k]) for k in keys)} {r.problem}" for r in bad)
        raise ValueError(f"keys of {table} refused: {listed}")


OUTCOME = "table_name string, check_name string, measured bigint, passed boolean"


def uniqueness(df: DataFrame, table: str, *keys: str) -> DataFrame:
    """One row in the shape of :func:`report`: duplicated keys. Only the key columns are read."""
    duplicates = duplicated_keys(df.select(*keys), *keys).agg(F.count("*").alias("n"))
    return duplicates.select(F.inline(F.array(_outcome(table, f"unique {', '.join(keys)}", F.col("n"), F.col("n") == 0))))


def reference_report(
    child: DataFrame, table: str, foreign_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """One row in the shape of :func:`report`: child rows without a parent."""
    missing = orphans(child, foreign_key, parent, parent_key).agg(
        F.coalesce(F.sum("child_rows"), F.lit(0)).alias("n")
    )
    outcome = _outcome(table, f"references {foreign_key}", F.col("n"), F.col("n") == 0)
    return missing.select(F.inline(F.array(outcome)))


def validate(checks: DataFrame, raise_error: bool = False) -> list[str]:
    """Names of failed checks; the report holds a handful of rows by construction."""
    failed = [
        f"{r.table_name}: {r.check_name} ({r.measured})" for r in checks.filter("NOT passed").collect()
    ]
    if failed and raise_error:
        raise ValueError("data quality failed: " + "; ".join(failed))
    return failed


@dataclass(frozen=True)
class ColumnRule:
    """What one landing column must look like; checks see the value cast to ``dtype``."""

    column: str
    dtype: str
    nullable: bool = False
    checks: dict[str, str] = field(default_factory=dict)


def greater_than(bound: int) -> dict[str, str]:
    return {f"greater_than({bound})": "{0} > " + str(bound)}


def min_length(length: int) -> dict[str, str]:
    return {f"str_length({length}, None)": "length({0}) >= " + str(length)}


def in_range(low: int, high: int) -> dict[str, str]:
    return {f"in_range({low}, {high})": "{0} BETWEEN " + f"{low} AND {high}"}


def missing_columns(df: DataFrame, rules: Sequence[ColumnRule]) -> list[str]:
    return [r.column for r in rules if r.column not in df.columns]


def failure_cases(df: DataFrame, rules: Sequence[ColumnRule], row_key: str) -> DataFrame:
    """column_name, check_name, value, row_key of every broken rule, all rules in one pass."""
    absent = missing_columns(df, rules)
    if absent:
        raise ValueError(f"columns not in the input: {', '.join(absent)}")
    cases = []
    for rule in rules:
        raw = F.col(rule.column)
        typed = raw.try_cast(rule.dtype)
        broken = [(f"dtype({rule.dtype})", raw.isNotNull() & typed.isNull())]
        if not rule.nullable:
            broken.append(("not_nullable", raw.isNull()))
        cast = f"try_cast({rule.column} AS {rule.dtype})"
        broken += [(name, ~F.expr(sql.format(cast))) for name, sql in rule.checks.items()]
        cases += [
            F.when(
                condition,
                F.struct(
                    F.lit(rule.column).alias("column_name"),
                    F.lit(name).alias("check_name"),
                    raw.cast("string").alias("value"),
                    F.col(row_key).cast("string").alias("row_key"),
                ),
            )
            for name, condition in broken
        ]
    return df.select(F.inline(F.filter(F.array(*cases), lambda case: case.isNotNull())))


def require_valid(df: DataFrame, rules: Sequence[ColumnRule], row_key: str) -> None:
    """Raise with per-rule failure counts, or when there are no rows at all."""
    counts = failure_cases(df, rules, row_key).groupBy("column_name", "check_name").count().collect()
    if counts:
        listed = "; ".join(f"{r.column_name} {r.check_name}: {r['count']}" for r in counts)
        raise ValueError(f"landing validation failed: {listed}")
    if df.isEmpty():
        raise ValueError("landing input is empty")
