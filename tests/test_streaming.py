from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import StreamingQueryException

from lakekeel.plans import gold, silver
from lakekeel.plans.lake import Lake
from lakekeel.sources.topics import FolderTopic
from lakekeel.streaming.cycle import IncrementalCycle, run_notifications

AS_OF, HERE = "2024-06-30", "here"


def send(spark, topic, name, messages):
    values = [(m if isinstance(m, str) else json.dumps(m),) for m in messages]
    topic.send(spark.createDataFrame(values, "value string").coalesce(1), name)


def change(op, after, lsn=None, bare=False):
    record = {"op": op, "after": after, "before": after if op == "d" else None}
    if lsn is not None:
        record["source"] = {"lsn": lsn}
    return record if bare else {"payload": record}


def person(key, lsn, address="a1", mode="Marche/running", salary=1000.0, op="u"):
    row = {"id": key, "nom": f"N{key}", "prenom": f"P{key}", "date_naissance": 7000, "date_embauche": 18000,
           "business_unit": "bu", "salaire_brut": salary, "contrat": "CDI", "nb_conges_payes": 25,
           "adresse_complete": address, "moyen_deplacement": mode}
    return change(op, row, lsn, bare=key % 2 == 0)


def workout(key, lsn, employee=1, start="2024-02-01T00:00:00Z", op="u", created="2024-02-01T00:00:00Z"):
    row = {"activity_id": key, "employee_id": employee, "name": f"S{key}", "distance_m": 1200,
           "start_date_utc": start, "created_at": created}
    return change(op, row, lsn, bare=key % 2 == 1)


@pytest.fixture
def cycle(spark, folder):
    return make_cycle(spark, folder)


def make_cycle(spark, folder, **options):
    lake = Lake(spark, f"{folder}/lake")
    topics = {n: FolderTopic(f"{folder}/topics/{n}", max_files=1) for n in ("employees", "sports", "activities", "requests")}
    for n, topic in topics.items():
        send(spark, topic, "start", [])
    known = spark.createDataFrame(
        [(f"a{i}", HERE, '{"rows":[{"elements":[{"status":"OK","distance":{"value":%d},"duration":{"value":1}}]}]}' % (i * 1000))
         for i in range(1, 9)], "origin_address string, destination_address string, body string")
    answer = lambda wanted: wanted.join(known, ["origin_address", "destination_address"])
    return IncrementalCycle(lake, f"{folder}/checkpoints", HERE, **topics, provider=answer, as_of=AS_OF, **options)


def bonus(cycle):
    return {r.employee_id: (r.salaire_brut, r.distance_km) for r in cycle.lake.bonus_input.snapshot().collect()}


def counts(cycle):
    return {(r.employee_id, r.year): r.nb_activities_year for r in cycle.lake.wellbeing_of(cycle.as_of).collect()}


def test_late_distance_reaches_gold(spark, cycle):
    send(spark, cycle.employees, "one", [person(1, 10), person(2, 20, address=None)])
    cycle.process_employees()
    assert bonus(cycle) == {1: (1000.0, None), 2: (1000.0, None)}
    cycle.process_requests()
    assert bonus(cycle) == {1: (1000.0, 1.0), 2: (1000.0, None)}
    ways = {r.employee_id: r.distance_domicile_travail_m for r in cycle.lake.commute.snapshot().collect()}
    assert ways == {1: 1000, 2: None}


def test_older_change_in_a_later_batch_loses(spark, cycle):
    send(spark, cycle.employees, "one", [person(1, 50, salary=2.0)])
    cycle.process_employees()
    send(spark, cycle.employees, "two", [person(1, 40, salary=1.0)])
    cycle.process_employees()
    assert bonus(cycle)[1][0] == 2.0
    assert cycle.lake.employees.snapshot().first().salaire_brut == 2.0


def test_messages_without_position_count_in_order_of_arrival(spark, cycle):
    cycle.lake.sports.replace(spark.createDataFrame([(1, "Judo")], "id int, pratique_sport string"))
    for sport in ("Tennis", "Voile"):
        send(spark, cycle.sports, sport, [change("u", {"id": 1, "pratique_sport": sport})])
        cycle.process_sports()
    assert [tuple(r) for r in cycle.lake.sport_profile.snapshot().collect()] == [(1, "Voile")]


def test_activity_that_moves_is_counted_where_it_is_now(spark, cycle):
    send(spark, cycle.activities, "one", [workout(i, i) for i in range(20)])
    cycle.run()
    assert counts(cycle) == {(1, 2024): 20}
    send(spark, cycle.activities, "two", [
        workout(0, 100, employee=2), workout(1, 101, start="2023-02-01T00:00:00Z"),
        workout(2, 102, start="1706745600000000"), workout(3, 103, start="soon"),
    ])
    cycle.run()
    assert counts(cycle) == {(1, 2024): 18, (2, 2024): 1}
    for table in cycle.lake.tables:
        if table.exists():
            table.compact()
    send(spark, cycle.activities, "three", [workout(0, 200, start="2023-01-01T00:00:00Z"), workout(30, 201, employee=None)])
    cycle.run()
    assert counts(cycle) == {(1, 2024): 18, (None, 2024): 1}
    bad = spark.read.json(f"{cycle.lake.root}/quarantine/*").collect()
    assert [r.reason for r in bad] == ["unreadable start_date_utc"]


def test_a_new_year_finds_every_year_counted(spark, cycle):
    """What moved between years before and after New Year counts as one batch over all rows would count it."""
    send(spark, cycle.activities, "one", [workout(1, 1), workout(2, 2), workout(3, 3, start="2025-01-02T00:00:00Z")])
    cycle.run()
    assert counts(cycle) == {(1, 2024): 2}
    cycle.as_of = "2025-01-03"
    send(spark, cycle.activities, "two", [workout(1, 4, start="2025-01-01T00:00:00Z")])
    cycle.run()
    assert counts(cycle) == {(1, 2025): 2}
    everything = {(r.employee_id, r.year): r.nb_activities_year for r in cycle.lake.wellbeing.snapshot().collect()}
    batch = gold.wellbeing_counts(cycle.lake.activity.snapshot(), all_years=True)
    assert everything == {(1, 2024): 1, (1, 2025): 2}
    assert everything == {(r.employee_id, r.year): r.nb_activities_year for r in batch.collect()}


def _provider(spark, replies):
    """A provider that knows the given addresses at the moment it is asked."""
    def answer(wanted):
        body = {
            "OK": '{"rows":[{"elements":[{"status":"OK","distance":{"value":7000},"duration":{"value":1}}]}]}',
            "QUOTA": '{"rows":[{"elements":[{"status":"OVER_QUERY_LIMIT"}]}]}',
        }
        known = [(address, HERE, body[reply]) for address, reply in replies.items()]
        frame = spark.createDataFrame(known, "origin_address string, destination_address string, body string")
        return wanted.join(frame, ["origin_address", "destination_address"])
    return answer


def test_a_request_without_answer_stays_open(spark, cycle):
    replies = {}
    cycle.provider = _provider(spark, replies)
    send(spark, cycle.employees, "one", [person(1, 10)])
    cycle.run()
    assert bonus(cycle) == {1: (1000.0, None)} and cycle.lake.open_requests.snapshot().count() == 1
    replies["a1"] = "OK"
    cycle.run()
    assert bonus(cycle) == {1: (1000.0, 7.0)} and cycle.lake.open_requests.snapshot().isEmpty()


def test_a_failed_look_up_is_repaired(spark, cycle):
    replies = {"a1": "QUOTA"}
    cycle.provider = _provider(spark, replies)
    send(spark, cycle.employees, "one", [person(1, 10)])
    cycle.run()
    replies["a1"] = "OK"
    send(spark, cycle.employees, "two", [person(1, 20)])
    cycle.run()
    assert bonus(cycle) == {1: (1000.0, None)}
    cycle.retry_failed = True
    send(spark, cycle.employees, "three", [person(1, 30)])
    cycle.run()
    assert bonus(cycle) == {1: (1000.0, 7.0)}
    assert [r.status for r in cycle.lake.distances.snapshot().collect()] == ["OK"]


def test_a_request_sent_again_overwrites_a_failure(spark, cycle):
    replies = {"a1": "QUOTA"}
    cycle.provider = _provider(spark, replies)
    send(spark, cycle.employees, "one", [person(1, 10)])
    cycle.run()
    replies["a1"] = "OK"
    send(spark, cycle.requests, "by-hand", [{"origin_address": "a1", "destination_address": HERE}])
    cycle.run()
    assert bonus(cycle) == {1: (1000.0, 7.0)}


def test_created_at_is_set_once(spark, cycle):
    send(spark, cycle.activities, "one", [workout(1, 1, created="2024-01-01T00:00:00Z")])
    cycle.process_activities()
    send(spark, cycle.activities, "two", [workout(1, 2, created="2025-01-01T00:00:00Z", employee=9)])
    cycle.process_activities()
    row = cycle.lake.activities.snapshot().first()
    assert (row.employee_id, str(row.created_at)) == (9, "2024-01-01 00:00:00")


def test_deletes_on_request(spark, folder):
    cycle = make_cycle(spark, folder, apply_deletes=True)
    send(spark, cycle.employees, "one", [person(1, 1), person(2, 2)])
    send(spark, cycle.employees, "two", [person(1, 3, op="d")])
    send(spark, cycle.activities, "one", [workout(5, 1, employee=2), workout(6, 2, employee=2)])
    send(spark, cycle.activities, "two", [workout(5, 3, employee=2, op="d")])
    cycle.run()
    assert set(bonus(cycle)) == {2}
    assert counts(cycle) == {(2, 2024): 1}


def test_restart_and_empty_input_change_nothing(spark, cycle):
    send(spark, cycle.employees, "one", [person(1, 10)])
    cycle.run()
    before = bonus(cycle)
    written = len(cycle.lake.employees._folders())
    cycle.run()
    assert bonus(cycle) == before and len(cycle.lake.employees._folders()) == written


def test_any_split_equals_batch(spark, folder, seed=1):
    """Shuffled and cut anyhow, with batches replayed from the start, the lake equals one batch computation."""
    rng = random.Random(seed)
    people = [person(rng.randrange(6), lsn, address=rng.choice(["a1", "a2", "a3", None]), salary=float(lsn)) for lsn in range(40)]
    workouts = [workout(rng.randrange(15), lsn, employee=rng.randrange(4), op=rng.choice("cu"),
                        start=f"202{rng.choice('34')}-0{rng.randrange(1, 10)}-01T00:00:00Z") for lsn in range(60)]
    newest_person, newest_workout = {}, {}
    for m in people:
        newest_person[m.get("payload", m)["after"]["id"]] = m.get("payload", m)["after"]
    for m in workouts:
        newest_workout[m.get("payload", m)["after"]["activity_id"]] = m.get("payload", m)["after"]
    rng.shuffle(people)
    rng.shuffle(workouts)
    cycle = make_cycle(spark, folder, compact_after=2)
    for part in range(3):
        send(spark, cycle.employees, f"p{part}", people[part * 14:(part + 1) * 14] + ["{broken"])
        send(spark, cycle.activities, f"p{part}", workouts[part * 20:(part + 1) * 20])
        cycle.run()
    again = IncrementalCycle(
        cycle.lake, f"{folder}/second", HERE, cycle.employees, cycle.sports, cycle.activities, cycle.requests,
        provider=cycle.provider, as_of=AS_OF,
    )
    expected_bonus = {k: (r["salaire_brut"], float(r["adresse_complete"][1]) if r["adresse_complete"] else None)
                      for k, r in newest_person.items()}
    expected_counts = {}
    for r in newest_workout.values():
        if r["start_date_utc"].startswith("2024"):
            expected_counts[r["employee_id"], 2024] = expected_counts.get((r["employee_id"], 2024), 0) + 1
    assert bonus(cycle) == expected_bonus
    assert counts(cycle) == expected_counts
    again.process_employees()
    again.process_activities()
    assert bonus(cycle) == expected_bonus
    bronze = cycle.lake.activities.snapshot()
    batch = gold.wellbeing_counts(silver.activity(bronze), AS_OF)
    assert {(r.employee_id, r.year): r.nb_activities_year for r in batch.collect()} == expected_counts


def test_notifications_only_for_new_activities(spark, folder):
    inbox, outbox = FolderTopic(f"{folder}/in"), FolderTopic(f"{folder}/out")
    send(spark, inbox, "one", [workout(1, 1, op="c"), workout(2, 2, op="u"), "{broken", workout(3, 3, employee=9, op="c")])
    people = spark.createDataFrame([(1, "Morel", "Zoé")], "id int, nom string, prenom string")
    run_notifications(inbox, outbox, lambda: people, spark, f"{folder}/checkpoint")
    run_notifications(inbox, outbox, lambda: people, spark, f"{folder}/checkpoint")
    sent = sorted(json.loads(r.value)["employee_fullname"] for r in outbox.read(spark).collect())
    assert sent == ["Employé 9", "Zoé Morel"]


def test_a_failed_batch_is_made_good_by_the_next_run(spark, cycle):
    """Each step fails once half-way; running again leaves the same tables as if none had."""
    send(spark, cycle.employees, "one", [person(1, 10), person(3, 11, address="a3")])
    send(spark, cycle.activities, "one", [workout(i, i) for i in range(3)])
    steps = [cycle.lake.bonus_input, cycle.lake.commute, cycle.lake.activity, cycle.lake.wellbeing]
    for table in steps:
        def broken(*args, table=table, **options):
            del table.apply
            raise RuntimeError("lost")
        table.apply = broken
    failures = 0
    for _ in range(6):
        try:
            cycle.run()
            break
        except StreamingQueryException:
            failures += 1
    assert failures >= 2
    assert bonus(cycle) == {1: (1000.0, 1.0), 3: (1000.0, 3.0)}
    assert counts(cycle) == {(1, 2024): 3}
    assert cycle.lake.activities.snapshot().count() == 3


def test_old_files_of_a_topic_are_read(spark, tmp_path):
    import os
    import time

    from lakekeel.sources.topics import FolderTopic
    from lakekeel.streaming.cycle import drain

    topic, seen = FolderTopic(f"{tmp_path}/topic"), []
    for name, age in (("a", 0), ("b", 30 * 86_400)):
        topic.send(spark.createDataFrame([(name,)], "value string"), name)
        for folder, _, files in os.walk(f"{tmp_path}/topic/{name}"):
            for file in files:
                os.utime(f"{folder}/{file}", (time.time() - age,) * 2)
        drain(topic.stream(spark), lambda rows, _: seen.extend(r.value for r in rows.collect()), f"{tmp_path}/checkpoint")
    assert seen == ["a", "b"]


def test_a_new_checkpoint_does_not_replace_or_drop_batches(spark, tmp_path):
    import json

    from lakekeel.plans.lake import Lake
    from lakekeel.sources.topics import FolderTopic
    from lakekeel.streaming.cycle import IncrementalCycle

    lake = Lake(spark, f"{tmp_path}/lake")
    for i, compact in ((1, False), (2, True), (9, False)):
        topic = FolderTopic(f"{tmp_path}/sports{i}")
        value = json.dumps({"op": "c", "after": {"id": i, "pratique_sport": "Judo"}})
        topic.send(spark.createDataFrame([(value,)], "value string"))
        IncrementalCycle(lake, f"{tmp_path}/checkpoint{i}", "there", topic, topic, topic, topic).process_sports()
        if compact:
            lake.sports.compact()
    assert sorted(r.id for r in lake.sports.snapshot().collect()) == [1, 2, 9]


def test_a_batch_of_activities_is_parsed_once(spark, folder, monkeypatch):
    """The topic's files are read for the bronze rows; the messages set aside come from the same parse."""
    from lakekeel.streaming import cycle as module

    kept = []
    aside = module.rejected

    def seen(parsed):
        kept.append(parsed.is_cached)
        return aside(parsed)

    monkeypatch.setattr(module, "rejected", seen)
    from lakekeel import registry

    registry.all_queries()["stream_wellbeing_recompute"](spark, "/root/testdata/sf0.001").count()
    assert kept and all(kept)


def test_activities_told_of_are_parsed_once(spark, folder, monkeypatch):
    from lakekeel.streaming import cycle as module

    kept = []
    payloads = module.notifications

    def seen(activities, employees):
        kept.append(activities.is_cached)
        return payloads(activities, employees)

    monkeypatch.setattr(module, "notifications", seen)
    from lakekeel import registry

    registry.all_queries()["stream_restart"](spark, "/root/testdata/sf0.001").count()
    assert kept and all(kept)
