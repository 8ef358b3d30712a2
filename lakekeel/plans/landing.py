"""Landing files to typed, validated operational tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lakekeel.functions.temporal import as_instant, day_first_date
from lakekeel.operators.project import flattened, renamed
from lakekeel.operators.quality import ColumnRule, greater_than, in_range, min_length, require_valid
from lakekeel.schemas import (
    ACTIVITY_DOCUMENT,
    ACTIVITY_FIELDS,
    EMPLOYEE_HEADERS,
    EMPLOYEES,
    SPORT_HEADERS,
    SPORTS,
    column_names,
)
from lakekeel.sources.files import read_csv, read_json_lines, write_csv

# What landing rows must look like.
EMPLOYEE_RULES = (
    ColumnRule("id", "int", checks=greater_than(0)),
    ColumnRule("nom", "string", checks=min_length(1)),
    ColumnRule("salaire_brut", "int", nullable=True, checks=greater_than(0)),
    ColumnRule("nb_conges_payes", "int", nullable=True, checks=in_range(0, 100)),
    ColumnRule("adresse_complete", "string", nullable=True),
)
SPORT_RULES = (
    ColumnRule("id", "int", checks=greater_than(0)),
    ColumnRule("pratique_sport", "string", nullable=True),
)


def prepare_csv(spark: SparkSession, source: str, target: str, headers: dict[str, str]) -> None:
    """Comma CSV with display headers to ``;`` CSV with table column names."""
    write_csv(renamed(read_csv(spark, source, list(headers)), headers), target, sep=";")


def employee_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, list(EMPLOYEE_HEADERS.values()), sep=";")


def sport_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, list(SPORT_HEADERS.values()), sep=";")


def employees(rows: DataFrame) -> DataFrame:
    """Typed employees; dates are day first and become NULL when impossible."""
    return _typed(rows, EMPLOYEES)


def sports(rows: DataFrame) -> DataFrame:
    return _typed(rows, SPORTS)


def _typed(rows: DataFrame, schema: str) -> DataFrame:
    types = {f.name: f.dataType for f in T.StructType.fromDDL(schema).fields}
    return rows.select(*[
        (day_first_date(F.col(c)) if isinstance(types[c], T.DateType) else F.col(c).try_cast(types[c])).alias(c)
        for c in column_names(schema)
    ])


def activities(spark: SparkSession, path: str) -> DataFrame:
    """Typed activities of a JSON Lines file, each with the line it came from.

    A missing file or a malformed line is an error; unreadable instants are NULL.
    """
    documents = read_json_lines(spark, path, ACTIVITY_DOCUMENT)
    rows = documents.select(*flattened("document", ACTIVITY_FIELDS), F.col("line").alias("raw_payload"))
    instants = {
        c: as_instant(F.col(c), T.StringType()) for c in ("start_date_utc", "start_date_local")
    }
    return rows.withColumns(instants).withColumn("created_at", F.current_timestamp())


def land_reference_data(
    spark: SparkSession,
    employee_path: str,
    sport_path: str,
    append: Callable[[DataFrame, str], None],
) -> None:
    """Validate both files completely, then append both tables."""
    people, declarations = employee_rows(spark, employee_path), sport_rows(spark, sport_path)
    require_valid(people, EMPLOYEE_RULES, "id")
    require_valid(declarations, SPORT_RULES, "id")
    append(employees(people), "rh_employees")
    append(sports(declarations), "sport_activities")
