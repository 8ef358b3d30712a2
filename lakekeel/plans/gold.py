"""Silver to gold: bonus input, yearly activity counts, and the rules on top of them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lakekeel.functions.measures import kilometres
from lakekeel.functions.temporal import reference_day
from lakekeel.functions.text import normalised


@dataclass(frozen=True)
class BonusRule:
    """Longest commute in km per mode, matched on the start of the normalised mode."""

    # Modes, their limits and the share of gross salary.
    limits: tuple[tuple[str, float], ...] = (("marche/running", 15.0), ("vélo/trottinette", 25.0))
    rate: float = 0.05


@dataclass(frozen=True)
class WellbeingRule:
    # Activities needed within a year and the days they earn.
    activities: int = 15
    days: int = 5


def bonus_input(
    employees: DataFrame, commutes: DataFrame, as_of: dt.date | str | None = None
) -> DataFrame:
    """Employee and commute joined one to one, with the mode normalised and the distance in km."""
    people = employees.select("employee_id", "business_unit", "salaire_brut")
    carried = [c for c in commutes.columns if c.startswith("_")]
    ways = commutes.select("employee_id", "moyen_deplacement", "distance_domicile_travail_m", *carried)
    return people.join(ways, "employee_id").select(
        "employee_id",
        F.year(reference_day(as_of)).alias("year"),
        "business_unit",
        "salaire_brut",
        "moyen_deplacement",
        "distance_domicile_travail_m",
        normalised(F.col("moyen_deplacement")).alias("mode_normalise"),
        kilometres(F.col("distance_domicile_travail_m")).alias("distance_km"),
        *carried,
    )


def bonus(inputs: DataFrame, rule: BonusRule = BonusRule()) -> DataFrame:
    """Bonus input plus ``eligible`` and ``bonus_amount``; an unknown distance is not eligible."""
    eligible = F.lit(False)
    for mode, limit in rule.limits:
        eligible |= F.col("mode_normalise").startswith(mode) & (F.col("distance_km") <= limit)
    return inputs.withColumn("eligible", F.coalesce(eligible, F.lit(False))).withColumn(
        "bonus_amount", F.when(F.col("eligible"), F.col("salaire_brut") * F.lit(rule.rate)).otherwise(F.lit(0.0))
    )


def bonus_impact(bonuses: DataFrame, rule: BonusRule = BonusRule()) -> DataFrame:
    """Cost per business unit. Salaries are summed before the rate applies."""
    salaries = F.coalesce(F.sum(F.when(F.col("eligible"), F.col("salaire_brut"))), F.lit(0.0))
    return bonuses.groupBy("business_unit").agg(
        F.count("*").alias("employees"),
        F.count_if(F.col("eligible")).alias("eligible_employees"),
        (salaries * F.lit(rule.rate)).alias("total_bonus"),
    )


def bonus_total(bonuses: DataFrame, rule: BonusRule = BonusRule()) -> DataFrame:
    """The same over the whole company."""
    salaries = F.coalesce(F.sum(F.when(F.col("eligible"), F.col("salaire_brut"))), F.lit(0.0))
    return bonuses.agg(
        F.count("*").alias("employees"),
        F.count_if(F.col("eligible")).alias("eligible_employees"),
        (salaries * F.lit(rule.rate)).alias("total_bonus"),
    )


def wellbeing_counts(
    activities: DataFrame, as_of: dt.date | str | None = None, all_years: bool = False
) -> DataFrame:
    """Activities per employee and year, by default only the year of ``as_of``."""
    if not all_years:
        activities = activities.filter(F.col("activity_year") == F.year(reference_day(as_of)))
    return activities.groupBy("employee_id", F.col("activity_year").alias("year")).agg(
        F.count("*").alias("nb_activities_year"),
        F.min("activity_date").alias("first_activity_date"),
        F.max("activity_date").alias("last_activity_date"),
    )


def wellbeing_days(counts: DataFrame, rule: WellbeingRule = WellbeingRule()) -> DataFrame:
    """Yearly counts plus ``eligible`` and ``extra_days``."""
    reached = F.col("nb_activities_year") >= rule.activities
    return counts.withColumn("eligible", reached).withColumn(
        "extra_days", F.when(reached, F.lit(rule.days)).otherwise(F.lit(0))
    )
