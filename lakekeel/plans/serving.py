"""Catalog tables and views for SQL clients."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakekeel.sources.tables import create_database, save_external

# Columns and types of the serving views.
BONUS_VIEW = {
    "employee_id": "INT",
    "year": "INT",
    "business_unit": "STRING",
    "salaire_brut": "DOUBLE",
    "moyen_deplacement": "STRING",
    "distance_km": "DOUBLE",
}
WELLBEING_VIEW = {
    "employee_id": "INT",
    "year": "INT",
    "nb_activities_year": "LONG",
    "first_activity_date": "TIMESTAMP",
    "last_activity_date": "TIMESTAMP",
}


def create_view(spark: SparkSession, view: str, table: str, columns: dict[str, str]) -> DataFrame:
    casts = ", ".join(f"CAST({name} AS {dtype}) AS {name}" for name, dtype in columns.items())
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {casts} FROM {table}")
    return spark.table(view)


def publish_bonus(
    inputs: DataFrame, location: str, database: str = "gold", fmt: str = "parquet"
) -> DataFrame:
    """Bonus input as an external table and ``v_prime_sportive`` on top of it."""
    spark = inputs.sparkSession
    create_database(spark, database, f"{location}/{database}.db")
    save_external(inputs, f"{database}.prime_sportive_input", f"{location}/prime_sportive_input", fmt)
    return create_view(spark, f"{database}.v_prime_sportive", f"{database}.prime_sportive_input", BONUS_VIEW)


def publish_wellbeing(
    counts: DataFrame, location: str, database: str = "gold", fmt: str = "parquet"
) -> DataFrame:
    """Well-being counts as an external table and ``v_wellbeing`` on top of it."""
    spark = counts.sparkSession
    create_database(spark, database, f"{location}/{database}.db")
    save_external(counts, f"{database}.wellbeing_days_eligibility", f"{location}/wellbeing_days_eligibility", fmt)
    return create_view(
        spark, f"{database}.v_wellbeing", f"{database}.wellbeing_days_eligibility", WELLBEING_VIEW
    )
