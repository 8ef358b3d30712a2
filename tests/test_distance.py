from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakekeel.plans import distance

HERE, THERE = "here", "there"


@pytest.fixture
def cache(spark):
    rows = [
        ("a", HERE, 100, 10, "google_maps", "OK"), ("a", THERE, 900, 90, "google_maps", "OK"),
        ("a", HERE, 800, 80, "other", "OK"), ("b", HERE, None, None, "google_maps", "ZERO_RESULTS"),
    ]
    return spark.createDataFrame(rows, "origin_address string, destination_address string, distance_m int, duration_s int, provider string, status string")


@pytest.fixture
def commutes(spark):
    rows = [(1, "a"), (2, "b"), (3, "c"), (4, None), (5, "c"), (6, "a")]
    return spark.createDataFrame(rows, "employee_id int, adresse_complete string")


def test_one_row_per_employee(commutes, cache):
    found = {r.employee_id: r.distance_domicile_travail_m for r in distance.enriched_commute(commutes, cache, HERE).collect()}
    assert found == {1: 100, 2: None, 3: None, 4: None, 5: None, 6: 100}


def test_same_without_broadcast(commutes, cache, no_broadcast):
    test_one_row_per_employee(commutes, cache)


def test_requests(commutes, cache):
    assert [r.origin_address for r in distance.missing_requests(commutes, cache, HERE).collect()] == ["c"]
    retried = {r.origin_address for r in distance.missing_requests(commutes, cache, HERE, retry_failed=True).collect()}
    assert retried == {"b", "c"}
    message = distance.request_messages(distance.missing_requests(commutes, cache, HERE)).first().value
    assert message == '{"origin_address":"c","destination_address":"here"}'


def test_unreadable_requests_are_dropped(spark):
    raw = spark.createDataFrame([('{"origin_address":"c","destination_address":"h"}',)] * 2 + [("x",), ('{"destination_address":"h"}',)], "value string")
    assert [tuple(r) for r in distance.parse_requests(raw).collect()] == [("c", "h")]


@pytest.mark.parametrize("body, metres, seconds, status", [
    ('{"rows":[{"elements":[{"status":"OK","distance":{"value":5},"duration":{"value":6}}]}]}', 5, 6, "OK"),
    ('{"rows":[{"elements":[{"status":"NOT_FOUND"}]}]}', None, None, "NOT_FOUND"),
    ("{broken", None, None, "ERROR: 'rows'"),
    ('{"rows":[]}', None, None, "ERROR: list index out of range"),
    ('{"rows":[{}]}', None, None, "ERROR: 'elements'"),
    ('{"rows":[{"elements":[]}]}', None, None, "ERROR: list index out of range"),
    ('{"rows":[{"elements":[{}]}]}', None, None, "ERROR: 'status'"),
    ('{"rows":[{"elements":[{"status":"OK"}]}]}', None, None, "ERROR: 'distance'"),
    ('{"rows":[{"elements":[{"status":"OK","distance":{"value":5}}]}]}', None, None, "ERROR: 'duration'"),
    (None, None, None, "ERROR: 'rows'"),
])
def test_answers(spark, body, metres, seconds, status):
    df = spark.createDataFrame([("a", HERE, body)], "origin_address string, destination_address string, body string")
    row = distance.answers(df).first()
    assert (row.distance_m, row.duration_s, row.status) == (metres, seconds, status)
    assert row.error_message == (None if status == "OK" else status)


def test_stamp_marks_what_was_looked_at(commutes, cache):
    stamped = distance.stamped_commute(commutes, cache.withColumn("_seq", F.lit(4)), HERE)
    found = {r.employee_id: (r.distance_domicile_travail_m, r._cache_seq) for r in stamped.collect()}
    assert found == {1: (100, 4), 2: (None, 4), 3: (None, -1), 4: (None, -1), 5: (None, -1), 6: (100, 4)}
