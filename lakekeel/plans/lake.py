"""The tables of the lake and their full load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakekeel import schemas
from lakekeel.functions.temporal import reference_day
from lakekeel.operators.quality import OUTCOME, Observed, RowCheck, uniqueness, validate
from lakekeel.plans import distance, gold, silver
from lakekeel.session import together
from lakekeel.sources.files import overwrite_lake, read_lake
from lakekeel.sources.hashed import PARTS, HashedLog
from lakekeel.sources.tables import LakeTable
from lakekeel.sources.topics import Topic
from lakekeel.streaming.deltas import SignedCounts

SNAPSHOT_TABLES = ("rh_employees", "sport_activities", "strava_activities")


class Lake:
    """Bronze, silver and gold tables under one root folder.

    ``parts`` hash folders hold what batches look up by key: so many that one has
    some 128 MB. It is part of the layout.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", parts: int = PARTS):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

        def table(path: str, schema: str, keys: list[str], **options) -> LakeTable:
            return LakeTable(spark, f"{self.root}/{path}", schema, keys, fmt=fmt, **options)

        versions = {"order_by": ("_seq", "_cache_seq")}
        self.employees = table("bronze/rh_employees", schemas.EMPLOYEES, ["id"])
        self.sports = table("bronze/sport_activities", schemas.SPORTS, ["id"])
        self.activities = table(
            "bronze/strava_activities", schemas.ACTIVITIES, ["activity_id"], insert_only=("created_at",)
        )
        self.distances = table("distance_cache", schemas.DISTANCES, list(distance.CACHE_KEYS), hash_by="origin_address", parts=parts)
        self.employee = table("silver/employee", schemas.SILVER_EMPLOYEE, ["employee_id"], hash_by="employee_id", parts=parts)
        self.commute = table("silver/commute", schemas.SILVER_COMMUTE, ["employee_id"], hash_by="employee_id", parts=parts, **versions)
        # Who has lived at an address, so that a new distance finds them without a scan of all commutes.
        self.residents = HashedLog(spark, f"{self.root}/silver/residents", "adresse_complete string, employee_id int", ["adresse_complete"], parts)
        self.sport_profile = table("silver/sport_profile", schemas.SILVER_SPORT_PROFILE, ["employee_id"])
        self.activity = table(
            "silver/activity", schemas.SILVER_ACTIVITY, ["activity_id"], partition_by=("activity_year",)
        )
        self.bonus_input = table("gold/prime_sportive_input", schemas.GOLD_BONUS, ["employee_id"], **versions)
        # A missing employee id is a group of its own, so an empty key replaces NULL. All years are kept.
        self.wellbeing = table(
            "gold/wellbeing_days_eligibility", schemas.GOLD_WELLBEING + ", _who string", ["_who", "year"]
        )

        self.signed = SignedCounts(spark, f"{self.root}/gold/signed_counts", parts)
        self.open_requests = table("open_requests", schemas.REQUESTS, ["origin_address", "destination_address"])

    def known_residents(self) -> HashedLog:
        """The residents; of a lake from before they were kept, those of now."""
        if not self.residents.exists() and self.commute.exists():
            self.residents.replace(residents(self.commute.snapshot()))
        return self.residents

    def wellbeing_of(self, as_of: dt.date | str | None = None) -> DataFrame:
        """The counts of the year of ``as_of``."""
        return self.wellbeing.snapshot().filter(F.col("year") == F.year(reference_day(as_of)))

    @property
    def tables(self) -> list[LakeTable]:
        return [t for t in vars(self).values() if isinstance(t, LakeTable)]

    def compact(self, after: int = 16) -> None:
        together(*[partial(table.compact, after) for table in self.tables], partial(self.signed.fold, after),
                 partial(self.residents.fold, lambda rows: rows.select("adresse_complete", "employee_id").distinct(), after))


def bronze_snapshot(
    read_table: Callable[[str], DataFrame], root: str, tables: tuple[str, ...] = SNAPSHOT_TABLES
) -> dict[str, DataFrame]:
    """Overwrite one plain lake folder per operational table and read each back."""
    def snapshot(name: str) -> DataFrame:
        rows = read_table(name)
        overwrite_lake(rows, f"{root}/{name}")
        return read_lake(rows.sparkSession, f"{root}/{name}")

    return dict(zip(tables, together(*[partial(snapshot, name) for name in tables])))


def residents(commutes: DataFrame) -> DataFrame:
    return commutes.filter(F.col("adresse_complete").isNotNull()).select("adresse_complete", "employee_id").distinct()


def keyed_wellbeing(counts: DataFrame) -> DataFrame:
    return counts.withColumn("_who", F.coalesce(F.col("employee_id").cast("string"), F.lit("")))


def full_load(
    lake: Lake,
    read_table: Callable[[str], DataFrame],
    destination: str,
    as_of: dt.date | str | None = None,
    strict: bool = False,
    requests: Topic | None = None,
    retry_failed: bool = False,
) -> list[str]:
    """Rebuild every table from operational snapshots; returns the names of failed checks.

    ``read_table`` gives the operational tables and ``distance_cache`` by name.
    Each layer reads what the previous one wrote. With ``strict`` a failed check
    stops the load with silver and gold as they were. Address pairs the cache does not hold
    go to ``requests``, with ``retry_failed`` those it holds a failure of too. Of
    rows with one key, as after landing files twice, one stays.
    """
    bronze = {
        "rh_employees": lake.employees, "sport_activities": lake.sports,
        "strava_activities": lake.activities, "distance_cache": lake.distances,
    }
    together(*[partial(_refresh, table, read_table, name) for name, table in bronze.items()])

    people = silver.employee(lake.employees.snapshot(), as_of)
    ways = silver.commute(lake.employees.snapshot())
    profiles = silver.sport_profile(lake.sports.snapshot())
    workouts = silver.activity(lake.activities.snapshot())
    known = lake.distances.snapshot()
    silver_rows = [
        (lake.employee, people, "silver.employee", silver.employee_checks(as_of)),
        (lake.commute, distance.enriched_commute(ways, known, destination), "silver.commute", []),
        (lake.sport_profile, profiles, "silver.sport_profile", []),
        (lake.activity, workouts, "silver.activity", []),
    ]
    writes = [lambda: checked_replace(silver_rows, strict)]
    if requests:
        wanted = distance.missing_requests(ways, known, destination, retry_failed)
        writes.append(partial(requests.send, distance.request_messages(wanted), "full-load"))
    if strict:  # nothing is asked for unless the checks pass
        results = [write() for write in writes]
    else:
        results = together(*writes)
    failed = validate(results[0])

    bonuses = gold.bonus_input(lake.employee.snapshot(), lake.commute.snapshot(), as_of)
    counts = keyed_wellbeing(gold.wellbeing_counts(lake.activity.snapshot(), all_years=True))
    together(
        partial(lake.bonus_input.replace, bonuses), partial(lake.wellbeing.replace, counts),
        partial(lake.signed.seed, lake.activity.versioned()), partial(lake.residents.replace, residents(lake.commute.snapshot())),
    )
    return failed


def checked_replace(tables: list[tuple[LakeTable, DataFrame, str, list[RowCheck]]], strict: bool = False) -> DataFrame:
    """Replace tables by (table, rows, name, row checks), each read once: the writes measure volume and row checks.

    Keys are checked on what was written, by their columns alone. Returns the
    report. With ``strict`` a failed check leaves all tables as they were; else
    they are published whatever the report says.
    """
    spark = tables[0][0].spark
    observed = [Observed(name, checks) for _, _, name, checks in tables]
    numbers = together(*[partial(t.stage, o.attach(rows)) for (t, rows, _, _), o in zip(tables, observed)])
    try:
        outcomes = spark.createDataFrame([row for o in observed for row in o.outcomes()], OUTCOME)
        for (table, _, name, _), number in zip(tables, numbers):
            outcomes = outcomes.unionByName(uniqueness(table.staged(number), name, *table.keys))
        found = spark.createDataFrame(outcomes.collect(), OUTCOME)  # a handful of rows
        validate(found, raise_error=strict)
    except ValueError:
        for (table, *_), number in zip(tables, numbers):
            table.discard(number)
        raise
    for (table, *_), number in zip(tables, numbers):
        table.publish(number)
    return found


def _refresh(table: LakeTable, read_table: Callable[[str], DataFrame], name: str) -> None:
    rows = read_table(name)
    table.replace(rows, resolved=not table.repeats(rows))
