"""Table schemas, as DDL strings accepted by every Spark reader and ``from_json``."""

from pyspark.sql import types as T

# Operational tables.
EMPLOYEES = """
    id int, nom string, prenom string, date_naissance date, date_embauche date,
    business_unit string, salaire_brut double, contrat string, nb_conges_payes int,
    adresse_complete string, moyen_deplacement string"""
SPORTS = "id int, pratique_sport string"
ACTIVITIES = """
    activity_id bigint, employee_id int, name string, distance_m int, moving_time_s int,
    elapsed_time_s int, total_elev_gain_m int, type string, sport_type string,
    start_date_utc timestamp, start_date_local timestamp, timezone string, utc_offset_s int,
    commute boolean, manual boolean, private boolean, flagged boolean, calories int,
    raw_payload string, created_at timestamp"""
DISTANCES = """
    origin_address string, destination_address string, distance_m int, duration_s int,
    provider string, status string, error_message string, last_updated timestamp"""

REQUESTS = "origin_address string, destination_address string"

# Headers of the landing files and the table columns they become.
EMPLOYEE_HEADERS = {
    "ID salarié": "id",
    "Nom": "nom",
    "Prénom": "prenom",
    "Date de naissance": "date_naissance",
    "BU": "business_unit",
    "Date d'embauche": "date_embauche",
    "Salaire brut": "salaire_brut",
    "Type de contrat": "contrat",
    "Nombre de jours de CP": "nb_conges_payes",
    "Adresse du domicile": "adresse_complete",
    "Moyen de déplacement": "moyen_deplacement",
}
SPORT_HEADERS = {"ID salarié": "id", "Pratique d'un sport": "pratique_sport"}

# The fields read from one activity of a JSON Lines file.
ACTIVITY_DOCUMENT = """
    id bigint, athlete struct<id: int>, name string, distance int, moving_time int,
    elapsed_time int, total_elevation_gain int, type string, sport_type string,
    start_date string, start_date_local string, timezone string, utc_offset int,
    commute boolean, manual boolean, private boolean, flagged boolean, calories int"""
ACTIVITY_FIELDS = {
    "id": "activity_id",
    "athlete.id": "employee_id",
    "name": "name",
    "distance": "distance_m",
    "moving_time": "moving_time_s",
    "elapsed_time": "elapsed_time_s",
    "total_elevation_gain": "total_elev_gain_m",
    "type": "type",
    "sport_type": "sport_type",
    "start_date": "start_date_utc",
    "start_date_local": "start_date_local",
    "timezone": "timezone",
    "utc_offset": "utc_offset_s",
    "commute": "commute",
    "manual": "manual",
    "private": "private",
    "flagged": "flagged",
    "calories": "calories",
}

# Body returned by the distance provider.
PROVIDER_ANSWER = """
    rows array<struct<elements: array<struct<
        status: string, distance: struct<value: int>, duration: struct<value: int>>>>>"""

# Lake tables.
SILVER_EMPLOYEE = """
    employee_id int, nom string, prenom string,
    date_naissance date, jour_naissance int, mois_naissance int, annee_naissance int,
    date_embauche date, jour_embauche int, mois_embauche int, annee_embauche int,
    business_unit string, salaire_brut double, contrat string, nb_conges_payes int,
    adresse_complete string, code_postal string, ville string, moyen_deplacement string,
    age_annees bigint, anciennete_annees bigint"""
SILVER_COMMUTE = """
    employee_id int, adresse_complete string, code_postal string, ville string,
    moyen_deplacement string, distance_domicile_travail_m int, duree_domicile_travail_s int"""
SILVER_SPORT_PROFILE = "employee_id int, pratique_sport string"
SILVER_ACTIVITY = """
    activity_id bigint, employee_id int, activity_datetime_utc timestamp, activity_date date,
    activity_year int, sport_type string, type string, distance_m int, moving_time_s int,
    elapsed_time_s int"""
GOLD_BONUS = """
    employee_id int, year int, business_unit string, salaire_brut double,
    moyen_deplacement string, distance_domicile_travail_m int, mode_normalise string,
    distance_km double"""
GOLD_WELLBEING = """
    employee_id int, year int, nb_activities_year bigint, first_activity_date date,
    last_activity_date date"""


def column_names(ddl: str) -> list[str]:
    """Top-level column names of a DDL string."""
    return T.StructType.fromDDL(ddl).names
