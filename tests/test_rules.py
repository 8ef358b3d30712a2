from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekeel.functions import measures, temporal, text
from lakekeel.plans import gold, notify, silver


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_age_uses_mean_year_length(spark):
    born, today = F.lit("2008-12-01").cast("date"), F.lit("2026-12-01").cast("date")
    assert one(spark, temporal.whole_years(born, today)) == 17
    assert one(spark, temporal.whole_years(F.lit(None).cast("date"), today)) is None


@pytest.mark.parametrize("address, code, town", [
    ("Chemin des Dunes, Mireval", "", ""),
    (None, None, None),
    ("9 Quai Bleu, 34110 Mireval", "34110", "Mireval"),
    ("12345 rue X, 34000 Nimes ", "12345", "rue X, 34000 Nimes"),
])
def test_address_parts(spark, address, code, town):
    column = F.lit(address).cast("string")
    assert one(spark, text.postal_code(column)) == code
    assert one(spark, text.town(column)) == town


@pytest.mark.parametrize("practice, shown", [(None, "Aucune"), ("", "Aucune"), (" ", " "), ("Tennis", "Tennis")])
def test_declared_sport(spark, practice, shown):
    assert one(spark, text.declared_sport(F.lit(practice).cast("string"))) == shown


@pytest.mark.parametrize("value, day", [("6/7/1990", dt.date(1990, 7, 6)), ("06/07/1990", dt.date(1990, 7, 6)),
                                        ("31/02/1990", None), ("x", None)])
def test_day_first_dates(spark, value, day):
    assert one(spark, temporal.day_first_date(F.lit(value))) == day


@pytest.mark.parametrize("metres, km", [(250, 0.3), (350, 0.4), (None, 0.0), (1200, 1.2)])
def test_rounded_kilometres(spark, metres, km):
    assert one(spark, measures.rounded_kilometres(F.lit(metres).cast("int"))) == km


@pytest.mark.parametrize("metres, seconds, speed, kcal", [(1000, 250, 4.0, 40), (0, 619, 0.0, 61), (10, 0, 0.0, 0)])
def test_measures(spark, metres, seconds, speed, kcal):
    assert one(spark, measures.average_speed(F.lit(metres), F.lit(seconds))) == speed
    assert one(spark, measures.calories(F.lit(metres), F.lit(seconds))) == kcal


def test_trim_keeps_tabs(spark):
    assert one(spark, text.normalised(F.lit(" \tVÉLO "))) == "\tvélo"


def test_silver_accepts_epoch_days(spark):
    raw = spark.createDataFrame(
        [(1, "n", "p", 7491, None, "bu", 1.0, "CDI", 25, None, "x")],
        "id int, nom string, prenom string, date_naissance bigint, date_embauche bigint, business_unit string, "
        "salaire_brut double, contrat string, nb_conges_payes int, adresse_complete string, moyen_deplacement string",
    )
    row = silver.employee(raw, "2024-06-30").first()
    assert (row.date_naissance, row.annee_naissance, row.age_annees) == (dt.date(1990, 7, 6), 1990, 33)
    assert row.anciennete_annees is None and row.code_postal is None


def test_silver_activity_accepts_micros(spark):
    raw = spark.createDataFrame(
        [(1, 2, 1704067207179575, "s", "t", 1, 2, 3)],
        "activity_id bigint, employee_id int, start_date_utc bigint, sport_type string, type string, "
        "distance_m int, moving_time_s int, elapsed_time_s int",
    )
    row = silver.activity(raw).first()
    assert (row.activity_date, row.activity_year) == (dt.date(2024, 1, 1), 2024)


@pytest.mark.parametrize("mode, metres, eligible", [
    (" Marche/running ", 15000, True), ("Marche/running", 15001, False),
    ("VÉLO/Trottinette/Autres", 25000, True), ("Vélo/Trottinette", 25001, False),
    ("véhicule thermique/électrique", 1000, False), ("Marche/running", None, False), (None, 10, False),
])
def test_bonus_rule(spark, mode, metres, eligible):
    people = spark.createDataFrame([(1, "bu", 30000.0)], "employee_id int, business_unit string, salaire_brut double")
    ways = spark.createDataFrame(
        [(1, mode, metres)], "employee_id int, moyen_deplacement string, distance_domicile_travail_m int"
    )
    row = gold.bonus(gold.bonus_input(people, ways, "2024-06-30")).first()
    assert (row.year, row.eligible, row.bonus_amount) == (2024, eligible, 1500.0 if eligible else 0.0)


@pytest.mark.parametrize("activities, days", [(14, 0), (15, 5)])
def test_wellbeing_rule(spark, activities, days):
    acts = spark.range(activities).select(
        F.lit(1).alias("employee_id"), F.lit(2024).alias("activity_year"), F.lit("2024-02-01").cast("date").alias("activity_date")
    )
    assert gold.wellbeing_days(gold.wellbeing_counts(acts, "2024-06-30")).first().extra_days == days
    assert gold.wellbeing_counts(acts, "2023-06-30").isEmpty()


def test_sport_types(spark):
    df = spark.createDataFrame([("Randonnée",), ("Pétanque",), (None,), ("",)], "pratique_sport string")
    historic = [tuple(r)[1:] for r in notify.with_sport_type(df).collect()]
    live = [tuple(r)[1:] for r in notify.with_sport_type(df, live=True).collect()]
    assert historic == [("Walk", "Hike")] + [("Workout", "Workout")] * 3
    assert live == [("Hike", "Hike"), ("Workout", "Pétanque"), ("Workout", "Workout"), ("Workout", "Workout")]


def test_notifications_name_unknown_employees(spark):
    acts = spark.createDataFrame([(1, 7, "run", 350), (2, 8, None, None)], notify.NOTIFIED)
    people = spark.createDataFrame([(7, "Morel", "Zoé")], "id int, nom string, prenom string")
    payloads = notify.notifications(acts, people)
    assert {r.employee_fullname for r in payloads.collect()} == {"Zoé Morel", "Employé 8"}
    texts = sorted(r.value for r in notify.notification_messages(payloads).collect())
    assert texts[1] == (
        '{"employee_id":8,"employee_fullname":"Employé 8","employee_firstname":null,"employee_lastname":null,'
        '"distance_km":0.0,"activity_name":null}'
    )


def test_as_date_leaves_dates_alone(spark):
    assert one(spark, temporal.as_date(F.lit("2024-01-02").cast("date"), T.DateType())) == dt.date(2024, 1, 2)
