"""Named queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakekeel import schemas, standins as s
from lakekeel.functions import measures, temporal
from lakekeel.operators import changes, quality
from lakekeel.operators.incremental import KeyChecks, key_counts
from lakekeel.operators.joins import orphans
from lakekeel.operators.project import renamed
from lakekeel.operators.upsert import latest_per_key, upsert
from lakekeel.plans import distance, gold, landing, notify, serving, silver
from lakekeel.plans.lake import Lake, bronze_snapshot, checked_replace, full_load
from lakekeel.session import configure, workspace
from lakekeel.sources import files
from lakekeel.sources.tables import LakeTable, register_external
from lakekeel.sources.topics import FolderTopic
from lakekeel.sources.versions import VersionedSnapshots
from lakekeel.streaming.cycle import (
    IncrementalCycle, drain, notified_log, run_notifications, run_wellbeing_totals, run_wellbeing_updates,
)
from lakekeel.streaming.deltas import SignedCounts

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    _QUERIES[function.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Silver


@query
def silver_employee(spark, sf):
    return silver.employee(s.employees(spark, sf), s.AS_OF)


@query
def silver_commute(spark, sf):
    return silver.commute(s.employees(spark, sf))


@query
def silver_sport_profile(spark, sf):
    return silver.sport_profile(s.sports(spark, sf))


@query
def silver_activity(spark, sf):
    return silver.activity(s.activities(spark, sf))


@query
def commute_enriched(spark, sf):
    ways = silver.commute(s.employees(spark, sf))
    return distance.enriched_commute(ways, s.distances(spark, sf), s.DESTINATION)


# Gold


def _bonus_input(spark, sf) -> DataFrame:
    people = s.employees(spark, sf)
    ways = distance.enriched_commute(silver.commute(people), s.distances(spark, sf), s.DESTINATION)
    return gold.bonus_input(silver.employee(people, s.AS_OF), ways, s.AS_OF)


@query
def gold_bonus_input(spark, sf):
    return _bonus_input(spark, sf)


@query
def bonus_eligibility(spark, sf):
    return gold.bonus(_bonus_input(spark, sf))


@query
def bonus_impact_by_unit(spark, sf):
    return gold.bonus_impact(gold.bonus(_bonus_input(spark, sf)))


@query
def bonus_total(spark, sf):
    return gold.bonus_total(gold.bonus(_bonus_input(spark, sf)))


@query
def gold_wellbeing(spark, sf):
    return gold.wellbeing_counts(silver.activity(s.activities(spark, sf)), s.AS_OF)


@query
def wellbeing_eligibility(spark, sf):
    return gold.wellbeing_days(gold.wellbeing_counts(silver.activity(s.activities(spark, sf)), s.AS_OF))


@query
def wellbeing_by_year(spark, sf):
    dated = s.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("int").alias("employee_id"),
        F.to_date("o_orderdate").alias("activity_date"),
        F.year("o_orderdate").alias("activity_year"),
    )
    return gold.wellbeing_days(gold.wellbeing_counts(dated, all_years=True))


@query
def v_prime_sportive(spark, sf):
    database = f"gold_{uuid.uuid4().hex[:12]}"
    return serving.publish_bonus(_bonus_input(spark, sf), workspace(spark, "views"), database)


@query
def v_wellbeing(spark, sf):
    counts = gold.wellbeing_counts(silver.activity(s.activities(spark, sf)), s.AS_OF)
    database = f"gold_{uuid.uuid4().hex[:12]}"
    return serving.publish_wellbeing(counts, workspace(spark, "views"), database)


# Look-ups and measures


@query
def sporting_employees(spark, sf):
    return notify.sporting_employees(s.employees(spark, sf), s.sports(spark, sf))


@query
def activity_taxonomy(spark, sf):
    historic = notify.with_sport_type(s.sports(spark, sf))
    both = renamed(historic, {"id": "id", "pratique_sport": "pratique_sport", "type": "historic_type",
                              "sport_type": "historic_sport_type"})
    return notify.with_sport_type(both, live=True)


@query
def activity_measures(spark, sf):
    metres = F.when(F.col("activity_id") % 5 == 0, 0).otherwise(F.col("distance_m"))
    seconds = F.when(F.col("activity_id") % 9 == 0, 0).otherwise(F.col("moving_time_s"))
    return s.activities(spark, sf).select(
        "activity_id",
        measures.average_speed(metres, seconds).alias("average_speed"),
        measures.calories(metres, seconds).alias("calories"),
        temporal.local_time(F.col("start_date_utc"), F.col("utc_offset_s")).alias("start_date_local"),
    )


@query
def notification_payloads(spark, sf):
    known = s.employees(spark, sf).filter(F.col("id") % 6 != 0)
    return notify.notifications(s.activities(spark, sf), known)


# Distances


@query
def distance_requests(spark, sf):
    wanted = distance.missing_requests(silver.commute(s.employees(spark, sf)), s.distances(spark, sf), s.DESTINATION)
    return distance.request_messages(wanted)


@query
def distance_requests_retry(spark, sf):
    ways = silver.commute(s.employees(spark, sf))
    wanted = distance.missing_requests(ways, s.distances(spark, sf), s.DESTINATION, retry_failed=True)
    return distance.request_messages(wanted)


@query
def distance_answers(spark, sf):
    return distance.answers(s.responses(spark, sf))


@query
def distance_cache_upsert(spark, sf):
    stamp = F.lit("2024-06-30").cast("timestamp")
    fresh = distance.answers(s.responses(spark, sf)).withColumn("last_updated", stamp)
    return upsert(s.distances(spark, sf), fresh, distance.CACHE_KEYS)


# Landing and snapshots


@query
def csv_landing_employees(spark, sf):
    root = workspace(spark, "landing")
    files.write_csv(s.landing_employees(spark, sf), f"{root}/input", sep=",")
    landing.prepare_csv(spark, f"{root}/input", f"{root}/ready", schemas.EMPLOYEE_HEADERS)
    rows = landing.employee_rows(spark, f"{root}/ready")
    quality.require_valid(rows, landing.EMPLOYEE_RULES, "id")
    files.append_lake(landing.employees(rows), f"{root}/rh_employees")
    return files.read_lake(spark, f"{root}/rh_employees")


@query
def csv_landing_both(spark, sf):
    root = workspace(spark, "landing")
    files.write_csv(s.landing_employees(spark, sf), f"{root}/input/employees", sep=",")
    files.write_csv(s.landing_sports(spark, sf), f"{root}/input/sports", sep=",")
    landing.prepare_csv(spark, f"{root}/input/employees", f"{root}/employees", schemas.EMPLOYEE_HEADERS)
    landing.prepare_csv(spark, f"{root}/input/sports", f"{root}/sports", schemas.SPORT_HEADERS)
    landing.land_reference_data(
        spark, f"{root}/employees", f"{root}/sports",
        lambda rows, name: files.append_lake(rows, f"{root}/{name}"),
    )
    return files.read_lake(spark, f"{root}/rh_employees").join(
        files.read_lake(spark, f"{root}/sport_activities"), "id"
    ).select("id", "nom", "date_naissance", "pratique_sport")


@query
def jsonl_landing(spark, sf):
    root = workspace(spark, "landing")
    files.write_json_lines(s.activity_documents(spark, sf), f"{root}/activities")
    rows = landing.activities(spark, f"{root}/activities")
    checked = F.get_json_object("raw_payload", "$.id").cast("bigint") == F.col("activity_id")
    return rows.withColumn("raw_matches", checked).drop("raw_payload", "created_at")


@query
def bronze_snapshots(spark, sf):
    """Snapshot every operational table, read each back, count by path with ad-hoc SQL."""
    root = workspace(spark, "bronze")
    sources = {"rh_employees": s.employees, "sport_activities": s.sports, "strava_activities": s.activities}
    bronze_snapshot(lambda name: sources[name](spark, sf), root, tuple(sources))
    counts = [
        files.row_count(spark, f"{root}/{name}").select(F.lit(name).alias("table_name"), "row_count")
        for name in sources
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def bronze_employees(spark, sf):
    root = workspace(spark, "bronze")
    return bronze_snapshot(lambda name: s.employees(spark, sf), root, ("rh_employees",))["rh_employees"]


@query
def external_table(spark, sf):
    """Append to lake files and query them through a registered table."""
    path, name = f"{workspace(spark, 'external')}/sports", f"sports_{uuid.uuid4().hex[:12]}"
    rows = s.sports(spark, sf)
    files.append_lake(rows.filter("id % 2 = 0"), path)
    files.append_lake(rows.filter("id % 2 = 1"), path)
    register_external(spark, name, path)
    return spark.sql(f"SELECT pratique_sport, count(*) AS declarations FROM {name} GROUP BY pratique_sport")


# Data quality


@query
def dq_silver(spark, sf):
    people = s.employees(spark, sf)
    return (
        silver.employee_quality(silver.employee(people, s.AS_OF), s.AS_OF)
        .unionByName(silver.commute_quality(silver.commute(people)))
        .unionByName(silver.sport_profile_quality(silver.sport_profile(s.sports(spark, sf))))
        .unionByName(silver.activity_quality(silver.activity(s.activities(spark, sf))))
    )


@query
def dq_duplicated_keys(spark, sf):
    keyed = s.employees(spark, sf).select(F.when(F.col("id") % 9 != 0, F.col("adresse_complete")).alias("address"))
    return quality.duplicated_keys(keyed, "address")


@query
def dq_schema_failures(spark, sf):
    broken = F.col("id") % 10
    rows = s.employees(spark, sf).select(
        F.when(broken == 1, F.lit("x")).when(broken == 2, F.lit("-3")).otherwise(F.col("id").cast("string")).alias("id"),
        F.when(broken == 3, F.lit("")).when(broken == 4, F.lit(None)).otherwise(F.col("nom")).alias("nom"),
        F.when(broken == 5, F.lit("0")).when(broken == 6, F.lit(None)).otherwise(F.lit("25000")).alias("salaire_brut"),
        F.when(broken == 7, F.lit("101")).when(broken == 8, F.lit("100")).otherwise(F.lit("25")).alias("nb_conges_payes"),
        "adresse_complete",
        F.col("prenom").alias("row_name"),
    )
    return quality.failure_cases(rows, landing.EMPLOYEE_RULES, "row_name")


def _activities_of_some(spark, sf) -> DataFrame:
    """Activities where every 20th employee number does not exist."""
    employee = F.col("employee_id")
    lost = F.when(employee % 20 == 0, -employee - 1).when(employee % 20 == 1, F.lit(None)).otherwise(employee)
    return s.activities(spark, sf).withColumn("employee_id", lost)


@query
def dq_orphans(spark, sf):
    return orphans(_activities_of_some(spark, sf), "employee_id", s.employees(spark, sf), "id")


@query
def dq_constraints(spark, sf):
    people, cache = s.employees(spark, sf), s.distances(spark, sf)
    required = [quality.not_null(c) for c in ("id", "nom", "prenom", "adresse_complete")]
    return (
        quality.report(people, "rh_employees", required, unique=[["id"]])
        .unionByName(quality.report(
            cache, "distance_cache",
            [quality.not_null(c) for c in ("origin_address", "destination_address", "status")],
            unique=[list(distance.CACHE_KEYS), ["origin_address", "destination_address"]],
        ))
        .unionByName(quality.reference_report(
            _activities_of_some(spark, sf), "strava_activities", "employee_id", people, "id"
        ))
    )


# Changes and upserts


def _topic(spark: SparkSession, messages: DataFrame, path: str, batches: int = 2) -> FolderTopic:
    """A folder topic that a stream reads in about ``batches`` micro-batches."""
    parts = max(4, spark.sparkContext.defaultParallelism)
    topic = FolderTopic(path, max_files=math.ceil(parts / batches))
    topic.send(messages.repartition(parts, F.xxhash64("value")))
    return topic


@query
def cdc_parse(spark, sf):
    topic = _topic(spark, s.employee_messages(spark, sf), f"{workspace(spark, 'cdc')}/employees")
    parsed = changes.parse_changes(topic.read(spark), schemas.EMPLOYEES)
    return changes.accepted(parsed).drop("_deleted").withColumnRenamed("_seq", "seq")


@query
def cdc_rejected(spark, sf):
    root = workspace(spark, "cdc")
    employees = _topic(spark, s.employee_messages(spark, sf), f"{root}/employees").read(spark)
    activities = _topic(spark, s.activity_messages(spark, sf), f"{root}/activities").read(spark)
    people = changes.rejected(changes.parse_changes(employees, schemas.EMPLOYEES))
    workouts = changes.rejected(changes.parse_changes(activities, schemas.ACTIVITIES))
    return people.unionByName(workouts).groupBy("reason").agg(F.count("*").alias("messages"))


@query
def cdc_latest(spark, sf):
    topic = _topic(spark, s.activity_messages(spark, sf), f"{workspace(spark, 'cdc')}/activities")
    rows = changes.accepted(changes.parse_changes(topic.read(spark), schemas.ACTIVITIES))
    newest = latest_per_key(rows.drop("_deleted", "op"), ["activity_id"], ["_seq"])
    return newest.withColumnRenamed("_seq", "seq")


MIXED = "activity_id bigint, employee_id int, distance_m int, start_date_utc timestamp"


def _mixed_changes(spark, sf) -> DataFrame:
    topic = _topic(spark, s.mixed_messages(spark, sf), f"{workspace(spark, 'cdc')}/mixed")
    return changes.parse_changes(topic.read(spark), MIXED, ["activity_id"], ordered=True)


@query
def cdc_order(spark, sf):
    """Changes with a log position are newer than those with an event time, and these than silent ones."""
    rows = changes.accepted(_mixed_changes(spark, sf))
    silent = changes.order_vector(changes.BY_BATCH, F.lit(1))
    newest = latest_per_key(rows.withColumn("_seq", F.coalesce("_seq", silent)), ["activity_id"], ["_seq"])
    return newest.select("activity_id", "employee_id", "distance_m", "start_date_utc")


@query
def cdc_no_key(spark, sf):
    """Changes without a key are set aside, each of them."""
    return changes.rejected(_mixed_changes(spark, sf)).groupBy("reason").agg(F.count("*").alias("messages"))


def _order_versions(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Orders as a target without every 15th, and a source with every 3rd order changed: each order is in one or both."""
    orders = s.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").alias("created_at")
    )
    target = orders.filter("o_orderkey % 15 <> 0")
    source = orders.filter("o_orderkey % 3 = 0").withColumns({
        "o_orderstatus": F.lit("X"),
        "o_totalprice": F.col("o_totalprice") + 1,
        "created_at": F.lit("2030-01-01").cast(orders.schema["created_at"].dataType),
    })
    return target, source


@query
def upsert_all(spark, sf):
    target, source = _order_versions(spark, sf)
    return upsert(target, source, ["o_orderkey"])


@query
def upsert_set_once(spark, sf):
    target, source = _order_versions(spark, sf)
    return upsert(target, source, ["o_orderkey"], insert_only=["created_at"])


@query
def keyed_table(spark, sf):
    """Three change batches on a stored table, one of them sent twice, one older, then compaction."""
    target, source = _order_versions(spark, sf)
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double, created_at timestamp_ntz"
    table = LakeTable(
        spark, f"{workspace(spark, 'keyed')}/orders", schema, ["o_orderkey"], insert_only=("created_at",)
    )
    table.replace(target)
    for batch, seq in (("a", 2), ("a", 2), ("b", 1)):
        rows = source if batch == "a" else source.withColumn("o_totalprice", F.lit(-1.0))
        table.apply(rows.withColumn("_seq", F.lit(seq)), batch, resolved=True)
    gone = source.filter("o_orderkey % 7 = 0").withColumns({"_seq": F.lit(3), "_deleted": F.lit(True)})
    table.apply(gone, "c", resolved=True)
    table.compact()
    return table.snapshot()


@query
def dq_observed(spark, sf):
    """The checks of the silver tables, measured by the jobs that write them."""
    lake = Lake(spark, f"{workspace(spark, 'observed')}/lake")
    people = s.employees(spark, sf)
    return checked_replace([
        (lake.employee, silver.employee(people, s.AS_OF), "silver.employee", silver.employee_checks(s.AS_OF)),
        (lake.commute, silver.commute(people).withColumns({c: F.lit(None) for c in distance.MEASURES}), "silver.commute", []),
        (lake.sport_profile, silver.sport_profile(s.sports(spark, sf)), "silver.sport_profile", []),
        (lake.activity, silver.activity(s.activities(spark, sf)), "silver.activity", []),
    ])


@query
def landing_key_conflicts(spark, sf):
    """New employees against stored ones: some are there already, some come twice, some have no number."""
    people = s.employees(spark, sf)
    new = people.filter("id % 3 = 0").unionByName(people.filter("id % 30 = 0")).unionByName(
        people.filter("id % 50 = 1").withColumn("id", F.lit(None).cast("int"))
    )
    return quality.key_conflicts(new, people.filter("id % 2 = 0"), ["id"])


@query
def dq_incremental(spark, sf):
    """Employees and activities in three batches: late parents, a parent twice, children moved and taken away."""
    checks = KeyChecks(spark, f"{workspace(spark, 'keys')}/checks", parts=16)
    people, rows = s.employees(spark, sf).select("id"), s.activities(spark, sf).select("activity_id", "employee_id")
    early, late = people.filter("id % 4 <> 1"), people.filter("id % 4 = 1")
    moved = rows.filter("activity_id % 6 = 0")
    gone, come = key_counts(moved, "employee_id", -1), key_counts(moved.withColumn("employee_id", -F.col("employee_id") - 1), "employee_id")
    batches = [
        (key_counts(early, "id"), key_counts(rows, "employee_id")),
        (key_counts(late.unionByName(early.filter("id % 7 = 2")), "id"), gone.unionByName(come)),
        (key_counts(early.filter("id % 14 = 2"), "id", -1), None),
    ]
    for number, (parents, children) in enumerate(batches, 1):
        checks.apply(number, parents, children)
    checks.apply(3, *batches[2])  # a batch that comes again
    return checks.report()


@query
def schema_change(spark, sf):
    """Two generations of customers: the later one has a wider key, a wider balance and a column more."""
    table = VersionedSnapshots(spark, f"{workspace(spark, 'versions')}/customers")
    rows = s.table(spark, sf, "customer")
    table.add(rows.filter("c_custkey % 3 = 0").select(F.col("c_custkey").cast("int"), "c_name", F.floor("c_acctbal").cast("int").alias("c_acctbal")))
    table.add(rows.filter("c_custkey % 3 <> 0").select("c_name", F.col("c_custkey").cast("bigint"), "c_mktsegment", F.col("c_acctbal").cast("double")))
    return table.read().drop("_version")


@query
def pruned_lookup(spark, sf):
    """Some keys of a stored table with pending changes; only the partitions they can lie in are read."""
    target, source = _order_versions(spark, sf)
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice double, created_at timestamp_ntz"
    table = LakeTable(spark, f"{workspace(spark, 'pruned')}/orders", schema, ["o_orderkey"], hash_by="o_orderkey")
    table.replace(target)
    table.apply(source.withColumn("_seq", F.lit(2)), "a", resolved=True)
    table.apply(source.filter("o_orderkey % 7 = 0").withColumns({"_seq": F.lit(3), "_deleted": F.lit(True)}), "b", resolved=True)
    wanted = s.table(spark, sf, "customer").select((F.col("c_custkey") * 5).alias("o_orderkey"))
    return table.snapshot(within=wanted)


@query
def change_feed(spark, sf):
    """What changed activities counted for before and after a batch of moves, late old rows, deletes and new ones."""
    rows = silver.activity(s.activities(spark, sf))
    counts = SignedCounts(spark, f"{workspace(spark, 'feed')}/counts")
    counts.seed(rows.filter("activity_id % 9 <> 4").withColumn("_seq", F.lit(5)))
    key = F.col("activity_id")
    batch = [
        rows.filter(key % 6 == 0).withColumns({"employee_id": F.col("employee_id") + 1, "_seq": F.lit(6), "_deleted": F.lit(False)}),
        rows.filter(key % 10 == 1).withColumns({"employee_id": F.lit(-1), "_seq": F.lit(4), "_deleted": F.lit(False)}),
        rows.filter(key % 9 == 4).withColumns({"_seq": F.lit(1), "_deleted": F.lit(False)}),
        rows.filter(key % 15 == 0).withColumns({"_seq": F.lit(7), "_deleted": F.lit(True)}),
    ]
    feed = counts.feed(reduce(DataFrame.unionByName, batch), 1)
    return feed.select(
        "activity_id", F.col("before.employee_id").alias("employee_before"), F.col("after.employee_id").alias("employee_after"),
        F.col("after._deleted").alias("removed"), F.col("after.day").alias("day"),
    )


# Streams


@query
def stream_cdc_upsert(spark, sf):
    root = workspace(spark, "stream")
    topic = _topic(spark, s.activity_messages(spark, sf), f"{root}/topic", batches=3)
    table = LakeTable(
        spark, f"{root}/activities", schemas.ACTIVITIES, ["activity_id"], insert_only=("created_at",)
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = changes.accepted(changes.parse_changes(batch, schemas.ACTIVITIES))
        table.apply(rows, f"cdc-{batch_id}")

    drain(topic.stream(spark), apply, f"{root}/checkpoint")
    return table.snapshot()


_MESSAGES = {"employees": s.employee_messages, "sports": s.sport_messages, "activities": s.activity_messages}


def _cycle(spark: SparkSession, sf: str, *fed: str) -> IncrementalCycle:
    """A new lake and its change topics; ``fed`` names the topics that hold messages, and the distances."""
    root = workspace(spark, "cycle")
    lake = Lake(spark, f"{root}/lake")
    if "distances" in fed:
        lake.distances.replace(s.distances(spark, sf))
    topics = {
        name: _topic(spark, messages(spark, sf), f"{root}/topics/{name}", batches=1 if name == "sports" else 2)
        if name in fed else FolderTopic(f"{root}/topics/{name}")
        for name, messages in _MESSAGES.items()
    }
    return IncrementalCycle(
        lake, f"{root}/checkpoints", s.DESTINATION, **topics,
        requests=FolderTopic(f"{root}/topics/requests"), provider=s.answer(spark, sf), as_of=s.AS_OF,
    )


@query
def stream_cycle(spark, sf):
    """All change topics through one full cycle; what the gold tables and profiles say afterwards."""
    cycle = _cycle(spark, sf, "distances", *_MESSAGES)
    cycle.run()
    lake = cycle.lake
    counts = lake.wellbeing_of(s.AS_OF).drop("year")
    return (
        lake.bonus_input.snapshot()
        .join(lake.sport_profile.snapshot(), "employee_id")
        .join(counts, "employee_id", "left")
    )


@query
def stream_wellbeing_recompute(spark, sf):
    cycle = _cycle(spark, sf, "activities")
    cycle.process_activities()
    cycle.process_wellbeing()
    return cycle.lake.wellbeing_of(s.AS_OF)


@query
def stream_wellbeing_delta(spark, sf):
    """Creations; then moves and late old rows; then deletes, and the moves once more: counts kept by signed changes."""
    cycle = _cycle(spark, sf)
    cycle.apply_deletes = True
    created, moved = s.activity_messages(spark, sf, "c"), s.activity_messages(spark, sf, "u")
    for name, sent in (("created", created), ("moved", moved), ("again", moved.unionByName(s.activity_removals(spark, sf)))):
        cycle.activities.send(sent, name)
        cycle.process_activities()
        cycle.process_wellbeing()
    return cycle.lake.wellbeing_of(s.AS_OF)


@query
def stream_wellbeing_update(spark, sf):
    """Every activity arrives twice; a batch writes only the totals it changed."""
    root = workspace(spark, "stream")
    rows = silver.activity(s.activities(spark, sf))
    for _ in range(2):
        files.append_lake(rows, f"{root}/activity")
    found = len([name for name in files.children(spark, f"{root}/activity") if name.startswith("part-")])
    arriving = spark.readStream.schema(schemas.SILVER_ACTIVITY).option("maxFilesPerTrigger", math.ceil(found / 3)).parquet(f"{root}/activity")
    totals = LakeTable(spark, f"{root}/wellbeing", schemas.GOLD_WELLBEING, ["employee_id", "year"])
    run_wellbeing_updates(arriving, totals, f"{root}/checkpoint", s.AS_OF)
    return totals.snapshot()


@query
def stream_wellbeing_complete(spark, sf):
    """Every activity arrives twice and counts once."""
    root = workspace(spark, "stream")
    rows = silver.activity(s.activities(spark, sf))
    for _ in range(2):
        files.append_lake(rows, f"{root}/activity")
    arriving = spark.readStream.schema(schemas.SILVER_ACTIVITY).parquet(f"{root}/activity")
    totals = LakeTable(spark, f"{root}/wellbeing", schemas.GOLD_WELLBEING, ["employee_id", "year"])
    run_wellbeing_totals(arriving, totals, f"{root}/checkpoint", s.AS_OF)
    return totals.snapshot()


@query
def stream_distance_requests(spark, sf):
    """Requests sent for addresses employees live at after all changes."""
    cycle = _cycle(spark, sf, "distances", "employees")
    cycle.process_employees()
    current = cycle.lake.commute.snapshot().select(F.col("adresse_complete").alias("origin_address"))
    return distance.parse_requests(cycle.requests.read(spark)).join(current, "origin_address", "left_semi")


@query
def stream_distance_requests_all(spark, sf):
    """All requests sent, in two rounds: first reads, then moves and late old rows; also those for addresses people have left."""
    cycle = _cycle(spark, sf, "distances")
    messages = s.employee_messages(spark, sf)
    first = F.coalesce(F.get_json_object("value", "$.op"), F.get_json_object("value", "$.payload.op")).eqNullSafe("r")
    for name, rows in (("first", messages.filter(first)), ("later", messages.filter(~first))):
        cycle.employees.send(rows, name)
        cycle.process_employees()
    return distance.parse_requests(cycle.requests.read(spark))


@query
def stream_late_answers(spark, sf):
    """A provider that answers a third of the requests, then none, then all: what stays open is asked again."""
    cycle = _cycle(spark, sf, "distances")
    wanted = distance.missing_requests(silver.commute(s.employees(spark, sf)), s.distances(spark, sf), s.DESTINATION)
    cycle.requests.send(distance.request_messages(wanted), "once")
    whole = cycle.provider
    cycle.provider = lambda asked: whole(asked).filter("pmod(xxhash64(origin_address), 3) = 0")
    cycle.process_requests()
    cycle.provider = lambda asked: whole(asked).filter("false")
    cycle.process_open_requests()
    cycle.provider = whole
    cycle.process_open_requests()
    return cycle.lake.distances.snapshot().drop("last_updated")


@query
def stream_distance_answers(spark, sf):
    cycle = _cycle(spark, sf, "distances")
    wanted = distance.missing_requests(silver.commute(s.employees(spark, sf)), s.distances(spark, sf), s.DESTINATION)
    cycle.requests.send(distance.request_messages(wanted), "once")
    cycle.requests.send(distance.request_messages(wanted), "again")
    cycle.process_requests()
    return cycle.lake.distances.snapshot().drop("last_updated")


@query
def stream_notifications(spark, sf):
    root = workspace(spark, "stream")
    topic = _topic(spark, s.activity_messages(spark, sf), f"{root}/topic")
    outbox = FolderTopic(f"{root}/outbox")
    known = s.employees(spark, sf).filter(F.col("id") % 6 != 0)
    run_notifications(topic, outbox, lambda: known, spark, f"{root}/checkpoint")
    return _payloads(outbox, spark)


def _payloads(outbox: FolderTopic, spark: SparkSession) -> DataFrame:
    fields = (
        "employee_id int, employee_fullname string, employee_firstname string, "
        "employee_lastname string, distance_km double, activity_name string"
    )
    return outbox.read(spark).select(F.from_json("value", fields).alias("p")).select("p.*")


def _told(spark, sf, rounds) -> DataFrame:
    """What was told of after some rounds of (messages, name of the checkpoint)."""
    root = workspace(spark, "stream")
    topic, outbox = FolderTopic(f"{root}/topic"), FolderTopic(f"{root}/outbox")
    known = s.employees(spark, sf).filter(F.col("id") % 6 != 0)
    for number, (messages, checkpoint) in enumerate(rounds):
        if messages is not None:
            topic.send(messages, f"round-{number}")
        run_notifications(topic, outbox, lambda: known, spark, f"{root}/{checkpoint}", notified_log(spark, f"{root}/notified"))
    return _payloads(outbox, spark)


@query
def stream_notifications_once(spark, sf):
    """Every message twice in one topic; each activity is told of once."""
    messages = s.activity_messages(spark, sf)
    return _told(spark, sf, [(messages.unionByName(messages), "checkpoint")])


@query
def stream_restart(spark, sf):
    """A drain, a second one from the same checkpoint with old and new messages, and a third with a renewed checkpoint."""
    messages = s.activity_messages(spark, sf)
    some = messages.filter(F.pmod(F.xxhash64("value"), F.lit(3)) > 0)
    return _told(spark, sf, [(some, "checkpoint"), (messages, "checkpoint"), (None, "renewed")])


# Whole load


def _loaded_gold(spark, sf, times: int) -> DataFrame:
    lake = Lake(spark, f"{workspace(spark, 'load')}/lake")
    sources = {
        "rh_employees": s.employees, "sport_activities": s.sports,
        "strava_activities": s.activities, "distance_cache": s.distances,
    }

    def landed(name: str) -> DataFrame:
        rows = sources[name](spark, sf)
        return reduce(DataFrame.unionByName, [rows] * times)

    full_load(lake, landed, s.DESTINATION, s.AS_OF)
    counts = gold.wellbeing_days(lake.wellbeing_of(s.AS_OF)).select(
        "employee_id", "nb_activities_year", "extra_days"
    )
    return gold.bonus(lake.bonus_input.snapshot()).join(counts, "employee_id", "left")


@query
def full_load_gold(spark, sf):
    return _loaded_gold(spark, sf, 1)


@query
def full_load_landed_twice(spark, sf):
    """Every table holds each of its rows twice, as after landing all files twice."""
    return _loaded_gold(spark, sf, 2)
