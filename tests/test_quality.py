from __future__ import annotations

import pytest

from lakekeel.operators.quality import RowCheck, duplicated_keys, failure_cases, not_null, report, require_valid, validate
from lakekeel.plans.landing import EMPLOYEE_RULES


def outcome(df):
    return {r.check_name: (r.measured, r.passed) for r in df.collect()}


def test_null_outcome_is_no_failure_and_null_keys_repeat(spark):
    df = spark.createDataFrame([(1, 17), (None, 18), (None, None)], "k int, age int")
    checks = [RowCheck("of age", "age >= 18"), not_null("k")]
    assert outcome(report(df, "t", checks, unique=[["k"], ["k", "age"]])) == {
        "volume": (3, True), "of age": (1, False), "not null k": (2, False), "unique k": (1, False),
        "unique k, age": (0, True),
    }
    assert [tuple(r) for r in duplicated_keys(df, "k").collect()] == [(None, 2)]


def test_empty_table_fails_volume(spark):
    empty = spark.createDataFrame([], "k int")
    assert outcome(report(empty, "t")) == {"volume": (0, False)}
    assert validate(report(empty, "t")) == ["t: volume (0)"]
    with pytest.raises(ValueError, match="volume"):
        validate(report(empty, "t"), raise_error=True)


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id string, nom string, salaire_brut string, nb_conges_payes string, adresse_complete string")


def test_all_failures_are_collected(spark):
    df = rows(spark, ("1", "a", None, "0", None), ("-1", "", "0", "101", "x"), ("z", None, "9.5", "100", "x"))
    found = {(r.column_name, r.check_name, r.value) for r in failure_cases(df, EMPLOYEE_RULES, "id").collect()}
    assert found == {
        ("id", "greater_than(0)", "-1"), ("nom", "str_length(1, None)", ""), ("salaire_brut", "greater_than(0)", "0"),
        ("nb_conges_payes", "in_range(0, 100)", "101"), ("id", "dtype(int)", "z"), ("nom", "not_nullable", None),
        ("salaire_brut", "dtype(int)", "9.5"),
    }


def test_missing_column_and_empty_input_are_errors(spark):
    with pytest.raises(ValueError, match="salaire_brut"):
        failure_cases(spark.createDataFrame([("1", "a")], "id string, nom string"), EMPLOYEE_RULES, "id")
    with pytest.raises(ValueError, match="empty"):
        require_valid(rows(spark, ("1",) * 5).limit(0), EMPLOYEE_RULES, "id")
    with pytest.raises(ValueError, match="greater_than"):
        require_valid(rows(spark, ("0", "a", "1", "1", "a")), EMPLOYEE_RULES, "id")
