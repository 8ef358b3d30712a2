"""Order of changes, keys that must not be missing, notifications told once, schema versions, checks in the write, split scans."""

from __future__ import annotations

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakekeel import schemas
from lakekeel.operators.changes import BY_BATCH, BY_LOG, BY_OFFSET, BY_TIME, accepted, order_vector, parse_changes, rejected
from lakekeel.jobs import main
from lakekeel.operators.quality import RowCheck, key_conflicts, require_new_keys
from lakekeel.plans.lake import Lake, checked_replace
from lakekeel.sources.files import children, preview
from lakekeel.sources.relational import hash_predicates, quantile_query, range_predicates
from lakekeel.sources.tables import LakeTable
from lakekeel.sources.topics import FolderTopic
from lakekeel.sources.versions import SchemaConflict, VersionedSnapshots, evolved
from lakekeel.streaming.cycle import IncrementalCycle, notified_log, run_notifications, run_wellbeing_updates


def test_order_vector_sorts_like_its_parts(spark):
    pick = random.Random(1)
    edge = [-(1 << 62), -5, 0, 1, 1_700_000_000_000, (1 << 62) - 1]
    rows = [(r, pick.choice(edge), pick.choice([None, 0, 3, (1 << 61) - 1])) for r in (BY_BATCH, BY_OFFSET, BY_TIME, BY_LOG) for _ in range(20)]
    frame = spark.createDataFrame(rows, "r int, p bigint, t bigint")
    shown = F.coalesce(*(F.when(F.col("r") == r, order_vector(r, F.col("p"), F.col("t"))) for r in range(4)))
    found = [(r.v, (r.r, r.p, r.t or 0)) for r in frame.withColumn("v", shown).collect()]
    assert [x for _, x in sorted(found)] == sorted(x for _, x in found) and len({v for v, _ in found}) == len({x for _, x in found})
    assert frame.select(order_vector(3, F.lit(None).cast("bigint"))).first()[0] is None


def messages(spark, *records):
    return spark.createDataFrame([(json.dumps(r) if isinstance(r, dict) else r,) for r in records], "value string")


def test_changes_without_a_key_are_set_aside(spark):
    raw = messages(
        spark, {"op": "c", "after": {"id": 1, "nom": "A"}}, {"op": "u", "after": {"nom": "B"}}, {"op": "u", "after": {"id": None, "nom": "C"}},
        {"op": "d", "before": None}, {"op": "d", "before": {"id": 2}},
    )
    parsed = parse_changes(raw, schemas.EMPLOYEES, ["id"])
    assert sorted(r.reason for r in rejected(parsed).collect()) == ["no key"] * 3
    assert sorted((r.id, r.op) for r in accepted(parsed, True).collect()) == [(1, "c"), (2, "d")]
    ignored = parse_changes(raw, schemas.EMPLOYEES, ["id"], deletes=False)
    assert rejected(ignored).count() == 2


def cycle(spark, folder):
    topics = {n: FolderTopic(f"{folder}/topics/{n}") for n in ("employees", "sports", "activities", "requests")}
    return IncrementalCycle(Lake(spark, f"{folder}/lake"), f"{folder}/checkpoints", "D", as_of="2024-06-30", **topics)


def test_bronze_keeps_every_nameless_message(spark, folder):
    run = cycle(spark, folder)
    run.employees.send(messages(spark, *({"op": "c", "after": {"nom": n}} for n in "ABC"), {"op": "c", "after": {"id": 4, "nom": "D"}}), "a")
    run.process_employees()
    assert [r.nom for r in run.lake.employees.snapshot().collect()] == ["D"]
    aside = spark.read.option("recursiveFileLookup", True).json(f"{folder}/lake/quarantine")
    assert sorted(json.loads(r.value)["after"]["nom"] for r in aside.collect()) == ["A", "B", "C"] and aside.select("reason").distinct().collect() == [("no key",)]


def test_log_position_beats_event_time_in_the_lake(spark, folder):
    """A snapshot row that tells only its time comes after a logged change, and does not undo it."""
    run = cycle(spark, folder)
    run.employees.send(messages(spark, {"op": "u", "after": {"id": 1, "nom": "logged"}, "source": {"lsn": 7}}), "a")
    run.process_employees()
    run.employees.send(messages(spark, {"op": "r", "after": {"id": 1, "nom": "timed"}, "ts_ms": 1_700_000_000_000}, {"op": "r", "after": {"id": 2, "nom": "silent"}}), "b")
    run.process_employees()
    assert {(r.id, r.nom) for r in run.lake.employees.snapshot().collect()} == {(1, "logged"), (2, "silent")}
    run.employees.send(messages(spark, {"op": "u", "after": {"id": 1, "nom": "later"}, "source": {"lsn": 8}}), "c")
    run.process_employees()
    assert {(r.id, r.nom) for r in run.lake.employee.snapshot().select(F.col("employee_id").alias("id"), "nom").collect()} == {(1, "later"), (2, "silent")}


def created(*ids):
    return [{"op": "c", "after": {"activity_id": i, "employee_id": 1, "name": f"n{i}", "distance_m": 1000}} for i in ids]


@pytest.mark.parametrize("once", [False, True])
def test_outbox_survives_a_renewed_checkpoint(spark, folder, once):
    topic, outbox = FolderTopic(f"{folder}/topic"), FolderTopic(f"{folder}/outbox")
    people = spark.createDataFrame([(1, "P", "N")], "id int, prenom string, nom string")
    log = notified_log(spark, f"{folder}/notified") if once else None
    for name, sent, checkpoint in (("a", created(1, 1, 2), "x"), ("b", created(2, 3), "x"), ("c", created(4), "renewed")):
        topic.send(messages(spark, *sent), name)
        run_notifications(topic, outbox, lambda: people, spark, f"{folder}/{checkpoint}", log)
    told = sorted(json.loads(r.value)["activity_name"] for r in outbox.read(spark).collect())
    assert told == (["n1", "n2", "n3", "n4"] if once else sorted(["n1", "n1", "n2", "n2", "n3"] * 2 + ["n4"]))


def test_batch_that_comes_again_tells_the_same(spark, folder):
    topic, outbox = FolderTopic(f"{folder}/topic"), FolderTopic(f"{folder}/outbox")
    people, log = spark.createDataFrame([], "id int, prenom string, nom string"), notified_log(spark, f"{folder}/notified")
    topic.send(messages(spark, *created(1, 2)), "a")
    run_notifications(topic, outbox, lambda: people, spark, f"{folder}/x", log)
    jvm = spark._jvm.org.apache.hadoop.fs
    commits = jvm.Path(f"{folder}/x/commits")
    commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, True)  # as if the driver was lost before the commit
    run_notifications(topic, outbox, lambda: people, spark, f"{folder}/x", log)
    assert outbox.read(spark).count() == 2


def test_updated_totals_write_only_changed_groups(spark, folder):
    target = LakeTable(spark, f"{folder}/t", schemas.GOLD_WELLBEING, ["employee_id", "year"])
    for batch, rows in enumerate([[(1, 1), (2, 2), (3, 3)], [(4, 2)], [(4, 2)]]):
        frame = spark.createDataFrame(rows, "activity_id bigint, employee_id int").withColumns({"activity_year": F.lit(2024), "activity_date": F.lit("2024-01-0%d" % (batch + 1)).cast("date")})
        frame.write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema(frame.schema).parquet(f"{folder}/in")
        run_wellbeing_updates(arriving, target, f"{folder}/c", "2024-06-30")
    assert {r.employee_id: r.nb_activities_year for r in target.snapshot().collect()} == {1: 1, 2: 2, 3: 1}
    written = [spark.read.parquet(f"{folder}/t/{n}").count() for n in children(spark, f"{folder}/t") if n.startswith("change")]
    assert written[:2] == [3, 1] and sum(written[2:]) <= 1


def schema(ddl):
    return T.StructType.fromDDL(ddl)


def test_schemas_grow():
    assert evolved(schema("a int, b float"), schema("b double, c string, a bigint")).simpleString() == "struct<a:bigint,b:double,c:string>"
    assert evolved(schema("a decimal(9,2), d int"), schema("a decimal(12,3), d decimal(10,0)")).simpleString() == "struct<a:decimal(12,3),d:decimal(10,0)>"
    assert evolved(schema("a int, gone string"), schema("a int")).simpleString() == "struct<a:int,gone:string>"


@pytest.mark.parametrize(("old", "new"), [("a bigint", "a int"), ("a double", "a float"), ("a string", "a int"), ("a bigint", "a double"), ("a decimal(10,2)", "a decimal(10,3)"), ("a int", "A int"), ("a bigint", "a decimal(19,0)")])
def test_schemas_do_not_shrink(spark, folder, old, new):
    table = VersionedSnapshots(spark, folder)
    table.add(spark.createDataFrame([], old))
    with pytest.raises(SchemaConflict):
        table.add(spark.createDataFrame([], new))
    assert len(children(spark, folder)) == 1


def test_versions_are_read_as_one(spark, folder):
    table = VersionedSnapshots(spark, folder)
    with pytest.raises(FileNotFoundError):
        table.read()
    table.add(spark.createDataFrame([(1, "x")], "k int, v string"))
    table.add(spark.createDataFrame([(1 << 40, 2.5)], "k bigint, w double"))
    table.add(spark.createDataFrame([(3, "z", None)], "k int, v string, w double").withColumn("k", F.col("k").cast("bigint")))
    assert sorted(map(tuple, table.read().collect())) == [(1, "x", None, 0), (3, "z", None, 2), (1 << 40, None, 2.5, 1)]
    assert "PushedFilters: [IsNotNull(k)" in table.read().filter("k > 5")._jdf.queryExecution().executedPlan().toString()


def test_strict_checks_leave_the_tables_as_they_were(spark, folder):
    table, other = (LakeTable(spark, f"{folder}/{n}", "k int, v int", ["k"]) for n in "ab")
    good, bad = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"), spark.createDataFrame([(1, -1), (1, 5)], "k int, v int")
    checks = [RowCheck("positive", "v > 0")]
    report = checked_replace([(table, good, "a", checks), (other, good, "b", [])], strict=True)
    assert {(r.table_name, r.check_name, r.measured, r.passed) for r in report.collect()} == {
        ("a", "volume", 2, True), ("a", "positive", 0, True), ("a", "unique k", 0, True), ("b", "volume", 2, True), ("b", "unique k", 0, True),
    }
    with pytest.raises(ValueError, match=r"a: positive \(1\)"):
        checked_replace([(other, good.limit(1), "b", []), (table, bad, "a", checks)], strict=True)
    assert table.snapshot().count() == other.snapshot().count() == 2 and len(children(spark, f"{folder}/a")) == 1
    found = {(r.check_name, r.measured) for r in checked_replace([(table, bad, "a", checks)]).collect()}
    assert found == {("volume", 2), ("positive", 1), ("unique k", 1)} and table.snapshot().count() == 2 and table.snapshot().filter("v = -1").count() == 1


def test_staged_rows_count_only_once_published(spark, folder):
    table = LakeTable(spark, folder, "k int", ["k"])
    number = table.stage(spark.createDataFrame([(1,)], "k int"))
    assert not table.exists() and table.staged(number).count() == 1
    table.publish(number)
    assert table.snapshot().count() == 1


def test_refused_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"), (3, "f")], "k int, v string")
    found = key_conflicts(rows, rows.filter("k = 2").unionByName(rows.filter("k = 2")), ["k"])
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "repeated"), (2, "present"), (None, "missing")]
    require_new_keys(rows.filter("k = 3"), None, ["k"], "t")
    with pytest.raises(ValueError, match="keys of t refused: 3 present"):
        require_new_keys(rows.filter("k = 3"), rows.filter("k = 3"), ["k"], "t")


def test_landing_twice_is_refused(spark, folder):
    rows = ",".join(schemas.SPORT_HEADERS) + "\n1,Judo\n"
    people = ",".join(schemas.EMPLOYEE_HEADERS) + '\n1,N,P,6/7/1990,B,14/12/2020,30000,CDI,25,"1 Rue, 34000 X",Marche/running\n'
    spark.createDataFrame([(rows,)], "value string").coalesce(1).write.text(f"{folder}/sport")
    spark.createDataFrame([(people,)], "value string").coalesce(1).write.text(f"{folder}/rh")
    arguments = ["land", "--root", f"{folder}/root", "--tables", f"{folder}/tables", "--employee-csv", f"{folder}/rh", "--sport-csv", f"{folder}/sport"]
    main(arguments, spark)
    with pytest.raises(ValueError, match="keys of rh_employees refused: 1 present"):
        main(arguments, spark)
    assert spark.read.parquet(f"{folder}/tables/rh_employees").count() == spark.read.parquet(f"{folder}/tables/sport_activities").count() == 1


def test_preview(spark, capsys):
    preview(spark.range(7), 2)
    shown = capsys.readouterr().out
    assert "id: long" in shown and "only showing top 2 rows" in shown


@pytest.mark.parametrize("predicates", [
    lambda c: range_predicates("k", [r[0] for r in c.execute(quantile_query("t", "k", 8)).fetchall()]), lambda c: range_predicates("k", []),
    lambda c: range_predicates("k", [5, 5, 1]), lambda c: hash_predicates(["s", "k"], 7, "hash({})"), lambda c: hash_predicates(["s"], 1),
])
def test_each_row_meets_one_predicate(predicates):
    """Uneven, negative, missing and very frequent keys; texts with quotes, and NULLs."""
    connection, pick = duckdb.connect(), random.Random(2)
    connection.execute("CREATE TABLE t (k BIGINT, s VARCHAR)")
    rows = [(pick.choice([None, 7, 7, 7, pick.randrange(-9, 9), pick.randrange(10**12)]), pick.choice([None, "", "a'b", "é", str(pick.random())])) for _ in range(500)]
    connection.executemany("INSERT INTO t VALUES (?, ?)", rows)
    found = predicates(connection)
    sizes = [connection.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in found]
    together = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in found)
    assert sum(sizes) == 500 and connection.execute(f"SELECT min({together}), max({together}) FROM t").fetchone() == (1, 1)
    assert len(found) == 1 or all(sizes)
