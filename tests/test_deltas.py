"""Signed counts, hash-laid logs and pruned look-ups against brute force."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakekeel.operators.incremental import KeyChecks, key_counts
from lakekeel.plans.lake import Lake
from lakekeel.sources.hashed import HashedLog
from lakekeel.sources.tables import LakeTable
from lakekeel.sources.topics import FolderTopic
from lakekeel.streaming.cycle import IncrementalCycle
from lakekeel.streaming.deltas import SignedCounts, counted_whole

ACTIVITY = "activity_id bigint, employee_id int, activity_year int, activity_date date, _seq bigint, _deleted boolean"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def days(pick) -> str:
    return f"{pick.choice([2023, 2024])}-0{pick.randrange(1, 4)}-1{pick.randrange(3)}"


def change(pick, seq) -> tuple:
    day = days(pick)
    return (pick.randrange(40), pick.choice([1, 2, 3, None]), int(day[:4]), day, seq, pick.random() < 0.2)


def frame(spark, rows):
    return spark.createDataFrame(rows, ACTIVITY.replace("date,", "string,").replace("activity_date date", "activity_date string")).withColumn(
        "activity_date", F.to_date("activity_date")
    )


def truth(log) -> dict:
    newest = {}
    for row in sorted(log, key=lambda r: (r[4], r[5], str(r[1] if r[1] is not None else ""), r[2], r[3])):
        newest[row[0]] = row
    groups = {}
    for _, who, year, day, _, deleted in newest.values():
        if not deleted:
            groups.setdefault((who, year), []).append(day)
    return {k: (len(v), min(v), max(v)) for k, v in groups.items()}


def counted(spark, counts, touched=None) -> dict:
    touched = touched or counts.days.read().select("_who", "year").distinct()
    return {
        (r.employee_id, r.year): (r.nb_activities_year, str(r.first_activity_date), str(r.last_activity_date)) for r in counts.counts(touched).collect()
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_signed_counts_equal_a_recount(spark, folder, seed):
    """Moves, deletes, old rows and batches that come again, from a seeded start, with folds in between."""
    pick = random.Random(seed)
    counts = SignedCounts(spark, folder, parts=4)
    start = {i: (i, pick.choice([1, 2, None]), 2024, "2024-01-11", 0, False) for i in range(20)}
    counts.seed(frame(spark, list(start.values())))
    log = list(start.values())
    for batch in range(1, 5):
        rows = [change(pick, pick.randrange(batch * 10)) for _ in range(25)]
        before = counted(spark, counts)
        log += rows
        touched = counts.apply(frame(spark, rows), batch)
        if batch % 2:
            touched = counts.apply(frame(spark, rows), batch)
        assert counted(spark, counts) == truth(log)
        named = {(r._who, r.year) for r in touched.collect()}
        after = truth(log)
        changed = {k for k in {*before, *after} if before.get(k) != after.get(k)}
        assert {("" if who is None else str(who), year) for who, year in changed} <= named
        counts.fold(after=2)
        assert counted(spark, counts) == truth(log)


def test_feed_has_both_images(spark, folder):
    counts = SignedCounts(spark, folder, parts=2)
    counts.seed(frame(spark, [(1, 5, 2024, "2024-01-10", 0, False), (2, 5, 2024, "2024-01-11", 0, False)]))
    feed = {r.activity_id: r for r in counts.feed(frame(spark, [(1, 6, 2024, "2024-01-10", 3, False), (2, 5, 2024, "2024-01-11", 0, False), (3, 5, 2024, "2024-02-01", 1, False)]), 1).collect()}
    assert sorted(feed) == [1, 3] and feed[1].before.employee_id == 5 and feed[1].after.employee_id == 6 and feed[3].before is None


def test_losing_the_last_day_needs_no_other_activity(spark, folder):
    counts = SignedCounts(spark, folder, parts=4)
    counts.seed(frame(spark, [(i, 1, 2024, f"2024-01-{10 + i}", 0, False) for i in range(5)]))
    counts.apply(frame(spark, [(4, 1, 2024, "2024-01-14", 1, True), (0, 1, 2023, "2023-05-05", 1, False)]), 1)
    assert counted(spark, counts) == {(1, 2024): (3, "2024-01-11", "2024-01-13"), (1, 2023): (1, "2023-05-05", "2023-05-05")}


def test_whole_count_is_the_first_build(spark):
    rows = frame(spark, [(1, None, 2024, "2024-01-10", 0, False), (2, 7, 2024, "2024-01-11", 0, False)])
    assert {(r._who, r.nb_activities_year) for r in counted_whole(rows).collect()} == {("", 1), ("7", 1)}


def test_log_reads_only_the_parts_of_its_keys(spark, folder):
    log = HashedLog(spark, folder, "k bigint, v string", ["k"], parts=16)
    assert not log.exists() and log.read().count() == 0
    for batch in (1, 2, 2):
        log.append(spark.range(400).select(F.col("id").alias("k"), F.lit(f"b{batch}").alias("v")), batch)
    assert log.read().count() == 800 and log.read(before=2).count() == log.read(batch=2).count() == 400
    wanted = spark.createDataFrame([(7,), (8,)], "k bigint")
    found = log.read(wanted)
    assert found.count() == 4 and "PartitionFilters: [_part" in plan(found).replace("isnotnull(_part", "_part").replace("[_part#", "[_part")
    touched = log.read().filter(F.col("_part").isin([r[0] for r in found.select("_part").distinct().collect()]))
    assert touched.select(F.input_file_name()).distinct().count() <= 4 < log.read().select(F.input_file_name()).distinct().count()
    assert log.fold(lambda rows: rows.dropDuplicates(["k"]), after=1) and log.read().count() == 800
    log.append(spark.range(5).select(F.col("id").alias("k"), F.lit("b3").alias("v")), 3)
    assert log.read(batch=3).count() == 5


def test_look_up_reads_only_its_partitions(spark, folder):
    """Files read follow from the keys of a batch, not from the table."""
    read = {}
    for rows in (400, 4000):
        table = LakeTable(spark, f"{folder}/{rows}", "k int, v string", ["k"], hash_by="k", parts=32)
        table.replace(spark.range(rows).select(F.col("id").cast("int").alias("k"), F.lit("v").alias("v")))
        table.apply(spark.createDataFrame([(3, "new", 5), (5000, "more", 5)], "k int, v string, _seq bigint"), "b")
        wanted = spark.createDataFrame([(3,), (5,), (5000,), (None,)], "k int")
        found = table.snapshot(within=wanted)
        assert {(r.k, r.v) for r in found.collect()} == {(3, "new"), (5, "v"), (5000, "more")}
        assert "_part" in plan(found).split("PartitionFilters: [")[1].split("]")[0]
        base, _ = table._committed()
        read[rows] = table._base(base, wanted).select(F.input_file_name()).distinct().count()
        assert table.snapshot().count() == rows + 1 and table.compact(share=0) and table.snapshot().count() == rows + 1
    assert read[400] == read[4000] <= 4


def test_table_without_hash_folders_is_still_read(spark, folder):
    old = LakeTable(spark, folder, "k int, v string", ["k"])
    old.replace(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    new = LakeTable(spark, folder, "k int, v string", ["k"], hash_by="k")
    assert [r.v for r in new.snapshot(within=spark.createDataFrame([(2,)], "k int")).collect()] == ["b"]


def test_moves_do_not_read_the_other_activities(spark, folder, monkeypatch):
    """After the first build neither base nor history of the activities is read for the counts."""
    topics = {n: FolderTopic(f"{folder}/topics/{n}") for n in ("employees", "sports", "activities", "requests")}
    run = IncrementalCycle(Lake(spark, f"{folder}/lake", parts=2), f"{folder}/checkpoints", "D", as_of="2024-06-30", apply_deletes=True, **topics)

    def send(name, *changes):
        rows = [(json.dumps({"op": op, ("before" if op == "d" else "after"): {"activity_id": i, "employee_id": who, "start_date_utc": day}, "source": {"lsn": lsn}}),) for op, i, who, day, lsn in changes]
        run.activities.send(spark.createDataFrame(rows, "value string"), name)
        run.process_activities()
        run.process_wellbeing()
        return {r.employee_id: (r.nb_activities_year, str(r.first_activity_date), str(r.last_activity_date)) for r in run.lake.wellbeing_of("2024-06-30").collect()}

    assert send("a", *(("c", i, 1 + i % 2, f"2024-01-{10 + i}T00:00:00Z", i) for i in range(6))) == {1: (3, "2024-01-10", "2024-01-14"), 2: (3, "2024-01-11", "2024-01-15")}
    def refuse(*_, **__):
        raise AssertionError("read the activities")

    for name in ("snapshot", "versioned", "history"):
        monkeypatch.setattr(run.lake.activity, name, refuse)
    assert send("b", ("u", 0, 2, "2024-01-10T00:00:00Z", 20), ("u", 5, 2, "2023-01-15T00:00:00Z", 21)) == {1: (2, "2024-01-12", "2024-01-14"), 2: (3, "2024-01-10", "2024-01-13")}
    assert send("c", ("d", 4, 1, None, 30), ("u", 5, 1, "2024-03-01T00:00:00Z", 5)) == {1: (1, "2024-01-12", "2024-01-12"), 2: (3, "2024-01-10", "2024-01-13")}


def test_residents_of_a_lake_from_before(spark, folder):
    lake = Lake(spark, folder)
    assert not lake.known_residents().exists()
    lake.commute.replace(spark.createDataFrame([(1, "a"), (2, None)], "employee_id int, adresse_complete string").withColumns(
        {c: F.lit(None) for c in ("code_postal", "ville", "moyen_deplacement", "distance_domicile_travail_m", "duree_domicile_travail_s")}
    ))
    assert [tuple(r) for r in lake.known_residents().read().select("adresse_complete", "employee_id").collect()] == [("a", 1)]


@pytest.mark.parametrize("seed", [3, 4])
def test_incremental_key_checks_equal_full_ones(spark, folder, seed):
    pick = random.Random(seed)
    checks, parents, children = KeyChecks(spark, folder, parts=4), Counter(), Counter()

    def part(held: Counter) -> list[tuple]:
        rows = [(pick.choice([*map(str, range(12)), None]), 1) for _ in range(15)]
        rows += [(k, -1) for k in list(held) if held[k] > 0 and pick.random() < 0.3]
        held.update({k: 0 for k, _ in rows if k})
        for k, n in rows:
            if k:
                held[k] += n
        return rows

    for batch in range(1, 5):
        sides = [spark.createDataFrame(part(held), "key string, n bigint") for held in (parents, children)]
        bad = checks.apply(batch, *sides)
        if batch == 2:
            bad = checks.apply(batch, *sides)
        found = {r.check_name: (r.measured, r.passed) for r in checks.report().collect()}
        twice, lost = sum(n > 1 for n in parents.values()), sum(max(n, 0) for k, n in children.items() if parents[k] <= 0)
        assert found == {"unique": (twice, not twice), "references": (lost, not lost)}
        for row in bad.collect():
            assert parents[row.key] > 1 if row.check_name == "unique" else parents[row.key] <= 0 < children[row.key]


def test_key_counts(spark):
    rows = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert {(r.key, r.n) for r in key_counts(rows, "k", -1).collect()} == {(1, -2), (None, -1)}
