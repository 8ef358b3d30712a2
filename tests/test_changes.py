from __future__ import annotations

import datetime as dt
import json

from lakekeel.operators.changes import accepted, inserts, parse_changes, rejected
from lakekeel.schemas import ACTIVITIES, EMPLOYEES, SPORTS


def topic(spark, *messages):
    return spark.createDataFrame([(m if m is None or isinstance(m, str) else json.dumps(m),) for m in messages], "value string")


def test_enveloped_and_bare_records(spark):
    raw = topic(
        spark,
        {"payload": {"op": "c", "after": {"id": 1, "pratique_sport": "Judo"}, "source": {"lsn": 4}}},
        {"op": "u", "after": {"id": 2}, "ts_ms": 9},
    )
    found = {(r.id, r.pratique_sport, r.op, r._seq) for r in accepted(parse_changes(raw, SPORTS)).collect()}
    assert found == {(1, "Judo", "c", 4), (2, None, "u", 9)}


def test_operations(spark):
    raw = topic(spark, *[{"op": op, "before": {"id": 8}, "after": {"id": 7}} for op in ("c", "u", "r", "d", None, "x")])
    parsed = parse_changes(raw, SPORTS)
    assert sorted(r.op for r in accepted(parsed).collect()) == ["c", "r", "u"]
    deleted = [r for r in accepted(parsed, apply_deletes=True).collect() if r._deleted]
    assert [(r.op, r.id) for r in deleted] == [("d", 8)]
    assert sorted(r.reason for r in rejected(parsed).collect()) == ["no operation", "unknown operation"]
    assert [r.op for r in inserts(parsed).collect()] == ["c"]


def test_malformed_messages_are_set_aside(spark):
    raw = topic(spark, "{broken", None, {"op": "c", "after": None}, {"op": "c", "after": {}}, {"payload": "text", "op": "c", "after": {"id": 3}})
    parsed = parse_changes(raw, SPORTS)
    assert [r.id for r in accepted(parsed).collect()] == [3]
    assert sorted(r.reason for r in rejected(parsed).collect()) == ["no operation", "no row image", "no row image"]
    assert "{broken" in {r.value for r in rejected(parsed).collect()}


def test_instants_as_text_micros_or_neither(spark):
    raw = topic(spark, *[
        {"op": "c", "after": {"activity_id": i, "start_date_utc": v}}
        for i, v in enumerate(["1704067207179575", "2025-01-01T00:00:00Z", "nope", None])
    ])
    parsed = parse_changes(raw, ACTIVITIES)
    found = {r.activity_id: r.start_date_utc for r in accepted(parsed).collect()}
    assert found == {
        0: dt.datetime(2024, 1, 1, 0, 0, 7, 179575), 1: dt.datetime(2025, 1, 1), 3: None,
    }
    assert [r.reason for r in rejected(parsed).collect()] == ["unreadable start_date_utc"]


def test_dates_as_epoch_days(spark):
    raw = topic(spark, {"op": "c", "after": {"id": 1, "date_naissance": 7491, "date_embauche": None}})
    row = accepted(parse_changes(raw, EMPLOYEES)).first()
    assert (row.date_naissance, row.date_embauche) == (dt.date(1990, 7, 6), None)


def test_position_orders_messages_without_their_own(spark):
    raw = spark.createDataFrame([('{"op":"c","after":{"id":1}}', 41)], "value string, position bigint")
    assert accepted(parse_changes(raw, SPORTS)).first()._seq == 41


def test_values_of_a_wrong_type_are_rejected(spark):
    import json

    rows = [{"id": "zz"}, {"id": 1, "salaire_brut": "abc"}, {"id": 2, "date_naissance": "1990-07-06"}, {"id": 3, "nb_conges_payes": 99999999999}, {"id": 4, "salaire_brut": 5}]
    raw = spark.createDataFrame([(json.dumps({"op": "c", "after": r}),) for r in rows], "value string")
    parsed = parse_changes(raw, "id int, salaire_brut double, date_naissance date, nb_conges_payes int")
    assert [r.id for r in accepted(parsed).collect()] == [4]
    assert sorted(r.reason for r in rejected(parsed).collect()) == [
        "unreadable date_naissance", "unreadable id", "unreadable nb_conges_payes", "unreadable salaire_brut"
    ]
