from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakekeel.plans import gold, serving
from lakekeel.plans.lake import Lake, full_load, keyed_wellbeing
from lakekeel.session import workspace
from lakekeel.sources.files import children
from lakekeel.sources.relational import Database
from lakekeel.sources.tables import create_database, save_external


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_shuffle(spark, folder, no_broadcast):
    create_database(spark, "buckets", f"{folder}/db")
    people = spark.range(100).select(
        F.col("id").cast("int").alias("employee_id"), F.lit("bu").alias("business_unit"), F.lit(1.0).alias("salaire_brut")
    )
    ways = spark.range(100).select(
        F.col("id").cast("int").alias("employee_id"), F.lit("m").alias("moyen_deplacement"),
        F.lit(1).alias("distance_domicile_travail_m"),
    )
    stored = [
        save_external(df, f"buckets.{name}", f"{folder}/{name}", bucket_by=(4, "employee_id"))
        for name, df in (("people", people), ("ways", ways))
    ]
    joined = gold.bonus_input(*stored, "2024-06-30")
    assert joined.count() == 100
    assert "Exchange" not in plan(joined)


def test_activity_base_prunes_by_year(spark, folder):
    lake = Lake(spark, folder)
    lake.activity.replace(spark.createDataFrame(
        [(1, 7, 2023), (2, 7, 2024)], "activity_id bigint, employee_id int, activity_year int"
    ).selectExpr(
        "activity_id", "employee_id", "current_timestamp() AS activity_datetime_utc", "current_date() AS activity_date",
        "activity_year", "'s' AS sport_type", "'t' AS type", "1 AS distance_m", "1 AS moving_time_s", "1 AS elapsed_time_s",
    ))
    current = gold.wellbeing_counts(lake.activity.snapshot(), "2024-06-30")
    assert [r.nb_activities_year for r in current.collect()] == [1]
    assert "activity_year#" in plan(current).split("PartitionFilters: [")[1].split("]")[0]
    scanned = plan(current).split("ReadSchema:")[1]
    assert "distance_m" not in scanned and "sport_type" not in scanned


def test_views_follow_overwritten_tables(spark, folder):
    counts = spark.createDataFrame([(1, 2024, 3)], "employee_id int, year int, nb_activities_year bigint").withColumns(
        {"first_activity_date": F.lit("2024-01-01").cast("date"), "last_activity_date": F.lit("2024-01-02").cast("date")}
    )
    view = serving.publish_wellbeing(counts, folder, "gold_views")
    assert dict(view.dtypes)["first_activity_date"] == "timestamp"
    serving.publish_wellbeing(counts.withColumn("nb_activities_year", F.lit(9).cast("bigint")), folder, "gold_views")
    assert spark.table("gold_views.v_wellbeing").first().nb_activities_year == 9
    save_external(counts.drop("first_activity_date"), "gold_views.other", f"{folder}/other")
    save_external(counts, "gold_views.other", f"{folder}/other")
    save_external(counts, "gold_views.other", f"{folder}/other")
    assert spark.table("gold_views.other").columns == counts.columns
    assert children(spark, f"{folder}/other") == ["v-0000000001", "v-0000000002"]


def test_full_load_can_stop_on_failed_checks(spark, folder):
    from lakekeel import standins as s
    from tests.test_oracles import SF_DIR

    sources = {"rh_employees": s.employees, "sport_activities": s.sports,
               "strava_activities": s.activities, "distance_cache": s.distances}
    read = lambda name: sources[name](spark, SF_DIR)
    with pytest.raises(ValueError, match="of age"):
        full_load(Lake(spark, f"{folder}/strict"), read, s.DESTINATION, "1977-01-01", strict=True)
    lake = Lake(spark, f"{folder}/lenient")
    failed = full_load(lake, read, s.DESTINATION, "1977-01-01")
    assert [f.split(" (")[0] for f in failed] == ["silver.employee: of age"]
    assert lake.bonus_input.snapshot().count() == 150


def test_workspace_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert workspace(spark, "x").startswith(shared) if shared else workspace(spark, "x").startswith("/tmp/run-")


class _Reader:
    """Stands for ``spark.read``: keeps the options a scan hands over."""

    def __init__(self, bounds):
        self.read, self.bounds, self.scans = self, bounds, []

    def format(self, _):
        return self

    def options(self, **options):
        self.scans.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return self.bounds


def test_split_scans_ask_for_their_bounds():
    reader = _Reader((3, 90))
    Database("jdbc:postgresql://db/x").read(reader, "t", split_on="id", partitions=4)
    asked, scan = reader.scans
    assert asked["query"] == "SELECT min(id) AS low, max(id) AS high FROM t"
    assert (scan["partitionColumn"], scan["lowerBound"], scan["upperBound"], scan["numPartitions"]) == ("id", "3", "90", "4")
    empty = _Reader((None, None))
    Database("jdbc:postgresql://db/x").read(empty, "t", split_on="id", partitions=4)
    assert "partitionColumn" not in empty.scans[-1]


def test_files_landed_twice_change_nothing(spark, folder):
    from lakekeel import standins as s
    from tests.test_oracles import SF_DIR

    sources = {"rh_employees": s.employees, "sport_activities": s.sports,
               "strava_activities": s.activities, "distance_cache": s.distances}
    loads = {}
    for times in (1, 2):
        lake = Lake(spark, f"{folder}/{times}")

        def read(name, times=times):
            rows = sources[name](spark, SF_DIR)
            return rows if times == 1 else rows.unionByName(rows)

        assert not full_load(lake, read, s.DESTINATION, s.AS_OF)
        loads[times] = [sorted(map(str, table.snapshot().collect())) for table in (lake.bonus_input, lake.wellbeing, lake.sport_profile)]
    assert loads[1] == loads[2]


def test_a_missing_employee_is_no_employee_number(spark, folder):
    lake = Lake(spark, folder)
    rows = [(None, 2024, 1), (-1, 2024, 2), (0, 2024, 3)]
    counts = spark.createDataFrame(rows, "employee_id int, year int, nb_activities_year bigint")
    dated = counts.withColumns({c: F.current_date() for c in ("first_activity_date", "last_activity_date")})
    lake.wellbeing.apply(keyed_wellbeing(dated), "a")
    assert {(r.employee_id, r.nb_activities_year) for r in lake.wellbeing.snapshot().collect()} == {(None, 1), (-1, 2), (0, 3)}


def test_a_batch_meets_only_the_rows_it_names(spark, folder):
    lake = Lake(spark, folder)
    schema = "id int, pratique_sport string"
    lake.sports.replace(spark.createDataFrame([(i, "Judo") for i in range(50)], schema))
    for name, changed in (("a", (3, 4)), ("b", (4, 70))):
        lake.sports.apply(spark.createDataFrame([(i, name) for i in changed], schema).withColumn("_seq", F.lit(ord(name))), name)
    wanted = spark.createDataFrame([(4,), (5,), (70,), (99,)], "id int")
    assert {tuple(r) for r in lake.sports.snapshot(within=wanted).collect()} == {(4, "b"), (5, "Judo"), (70, "b")}


def test_a_refresh_keeps_the_last_base_only(spark, folder):
    lake = Lake(spark, folder)
    for i in range(4):
        lake.sports.replace(spark.createDataFrame([(i, "Judo")], "id int, pratique_sport string"))
    assert [r.id for r in lake.sports.snapshot().collect()] == [3]
    assert len(lake.sports._folders()) == 2
