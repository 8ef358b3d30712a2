"""Bronze to silver: employee, commute, sport profile and activity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from lakekeel.functions.temporal import as_date, as_instant, date_parts, reference_day, whole_years
from lakekeel.functions.text import declared_sport, postal_code, town
from lakekeel.operators.quality import RowCheck, report

ADULT_AGE = 18


def _address_parts() -> list:
    address = F.col("adresse_complete")
    return [address, postal_code(address).alias("code_postal"), town(address).alias("ville")]


def employee(raw: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """One row per employee with split dates, split address, age and seniority."""
    today = reference_day(as_of)
    dated = raw.withColumns(
        {c: as_date(F.col(c), raw.schema[c].dataType) for c in ("date_naissance", "date_embauche")}
    )
    return dated.select(
        F.col("id").alias("employee_id"),
        "nom",
        "prenom",
        *date_parts("date_naissance", "naissance"),
        *date_parts("date_embauche", "embauche"),
        "business_unit",
        "salaire_brut",
        "contrat",
        "nb_conges_payes",
        *_address_parts(),
        "moyen_deplacement",
        whole_years(F.col("date_naissance"), today).alias("age_annees"),
        whole_years(F.col("date_embauche"), today).alias("anciennete_annees"),
        *_carried(raw),
    )


def commute(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("employee_id"), *_address_parts(), "moyen_deplacement", *_carried(raw)
    )


def sport_profile(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("employee_id"),
        declared_sport(F.col("pratique_sport")).alias("pratique_sport"),
        *_carried(raw),
    )


def activity(raw: DataFrame) -> DataFrame:
    start = as_instant(F.col("start_date_utc"), raw.schema["start_date_utc"].dataType)
    return raw.select(
        "activity_id",
        "employee_id",
        start.alias("activity_datetime_utc"),
        F.to_date(start).alias("activity_date"),
        F.year(start).alias("activity_year"),
        "sport_type",
        "type",
        "distance_m",
        "moving_time_s",
        "elapsed_time_s",
        *_carried(raw),
    )


def _carried(raw: DataFrame) -> list[str]:
    """System columns of a change row travel along with its silver row."""
    return [c for c in raw.columns if c in ("_seq", "_deleted")]


def employee_checks(as_of: dt.date | str | None = None) -> list[RowCheck]:
    today = "current_date()" if as_of is None else f"DATE '{as_of}'"
    return [
        RowCheck("birth date in the past", f"date_naissance < {today}"),
        RowCheck("of age", f"age_annees >= {ADULT_AGE}"),
    ]


def employee_quality(df: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    return report(df, "silver.employee", employee_checks(as_of), unique=[["employee_id"]])


def commute_quality(df: DataFrame) -> DataFrame:
    return report(df, "silver.commute", unique=[["employee_id"]])


def sport_profile_quality(df: DataFrame) -> DataFrame:
    return report(df, "silver.sport_profile", unique=[["employee_id"]])


def activity_quality(df: DataFrame) -> DataFrame:
    return report(df, "silver.activity", unique=[["activity_id"]])
