"""Notification payloads for newly created activities, and sport look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakekeel.functions.measures import rounded_kilometres
from lakekeel.functions.text import full_name
from lakekeel.operators.joins import lookup_join

# The part of an activity a notification shows.
NOTIFIED = "activity_id bigint, employee_id int, name string, distance_m int"

# Activity type and sport type per declared practice; first as
# recorded in historic activities, then as recorded live.
HISTORIC_SPORTS = {
    "Runing": ("Run", "Run"),
    "Randonnée": ("Walk", "Hike"),
    "Triathlon": ("Workout", "Triathlon"),
    "Natation": ("Swim", "Swim"),
    "Tennis": ("Workout", "Tennis"),
    "Badminton": ("Workout", "Badminton"),
    "Tennis de table": ("Workout", "TableTennis"),
    "Football": ("Workout", "Soccer"),
    "Basketball": ("Workout", "Basketball"),
    "Rugby": ("Workout", "Rugby"),
    "Boxe": ("Workout", "Boxing"),
    "Judo": ("Workout", "MartialArts"),
    "Escalade": ("Workout", "RockClimbing"),
    "Équitation": ("Ride", "EBikeRide"),
    "Voile": ("Workout", "Sailing"),
}
LIVE_SPORTS = {
    **HISTORIC_SPORTS,
    "Randonnée": ("Hike", "Hike"),
    "Équitation": ("Workout", "HorseRiding"),
}
OTHER_SPORT = "Workout"


def notifications(activities: DataFrame, employees: DataFrame) -> DataFrame:
    """One payload row per activity; an unknown employee shows as a numbered fallback."""
    people = employees.select(F.col("id").alias("employee_id"), "prenom", "nom")
    fallback = F.concat(F.lit("Employé "), F.coalesce(F.col("employee_id").cast("string"), F.lit("None")))
    return lookup_join(activities, people, ["employee_id"]).select(
        "activity_id",
        "employee_id",
        full_name(F.col("prenom"), F.col("nom"), fallback).alias("employee_fullname"),
        F.col("prenom").alias("employee_firstname"),
        F.col("nom").alias("employee_lastname"),
        rounded_kilometres(F.col("distance_m")).alias("distance_km"),
        F.col("name").alias("activity_name"),
    )


def notification_messages(payloads: DataFrame) -> DataFrame:
    """JSON text of each payload, NULL fields included."""
    fields = [c for c in payloads.columns if c != "activity_id"]
    return payloads.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def sporting_employees(employees: DataFrame, sports: DataFrame) -> DataFrame:
    declared = sports.filter(F.col("pratique_sport").isNotNull())
    return employees.join(declared, "id").select(
        F.col("id").alias("employee_id"), "nom", "prenom", "pratique_sport"
    )


def with_sport_type(df: DataFrame, live: bool = False) -> DataFrame:
    """Adds ``type`` and ``sport_type`` for the declared practice.

    An unknown practice is a workout; live records then name the practice itself
    as the sport type.
    """
    mapping = LIVE_SPORTS if live else HISTORIC_SPORTS
    entries = []
    for practice, (kind, sport) in mapping.items():
        entries += [F.lit(practice), F.struct(F.lit(kind).alias("type"), F.lit(sport).alias("sport_type"))]
    known = F.try_element_at(F.create_map(*entries), F.col("pratique_sport"))
    practice = F.nullif(F.col("pratique_sport"), F.lit(""))
    other = F.coalesce(practice, F.lit(OTHER_SPORT)) if live else F.lit(OTHER_SPORT)
    return df.select(
        "*",
        F.coalesce(known["type"], F.lit(OTHER_SPORT)).alias("type"),
        F.coalesce(known["sport_type"], other).alias("sport_type"),
    )
