from __future__ import annotations

import datetime as dt
import json
import os

import pytest

from lakekeel import schemas
from lakekeel.plans import landing
from lakekeel.sources.files import children, path_exists, read_csv, row_count


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write(text)
    return path


HEADER = ",".join(schemas.EMPLOYEE_HEADERS)
ROW = '7,Morel,Zoé,6/7/1990,Design,1/12/2020,31000,CDI,28,"9 Quai Bleu, 34110 ""Mireval""",Transports en commun'


def test_employee_csv(spark, folder):
    write(f"{folder}/in", "rh.csv", "\r\n".join([HEADER, ROW, '8,"","",31/02/1990,BU,x,,CDD,,,']) + "\r\n")
    landing.prepare_csv(spark, f"{folder}/in", f"{folder}/ready", schemas.EMPLOYEE_HEADERS)
    rows = {r.id: r for r in landing.employees(landing.employee_rows(spark, f"{folder}/ready")).collect()}
    assert rows[7].adresse_complete == '9 Quai Bleu, 34110 "Mireval"'
    assert (rows[7].date_naissance, rows[7].salaire_brut) == (dt.date(1990, 7, 6), 31000.0)
    assert (rows[8].nom, rows[8].date_naissance, rows[8].date_embauche, rows[8].salaire_brut) == (None,) * 4


def test_nothing_is_written_when_one_file_is_invalid(spark, folder):
    people = write(f"{folder}/p", "a.csv", ";".join(schemas.EMPLOYEE_HEADERS.values()) + "\n7;N;P;1/1/1990;B;1/1/2020;10;CDI;25;a;m\n")
    sports = write(f"{folder}/s", "a.csv", "id;pratique_sport\n0;Judo\n")
    written = []
    with pytest.raises(ValueError, match="greater_than"):
        landing.land_reference_data(spark, people, sports, lambda rows, name: written.append(name))
    assert written == []
    write(f"{folder}/s", "a.csv", "id;pratique_sport\n7;\n")
    landing.land_reference_data(spark, people, sports, lambda rows, name: written.append((name, rows.count())))
    assert written == [("rh_employees", 1), ("sport_activities", 1)]


def test_activities_from_json_lines(spark, folder):
    lines = [
        {"id": 1, "athlete": {"id": 5}, "distance": 10, "start_date": "2024-02-01T10:00:00Z", "map": {"id": "x"}},
        {"id": 2, "start_date": "never", "segment_efforts": []},
    ]
    path = write(folder, "a.jsonl", "\n\t\n".join(json.dumps(x) for x in lines) + "\n\n")
    rows = {r.activity_id: r for r in landing.activities(spark, path).collect()}
    assert (rows[1].employee_id, rows[1].start_date_utc) == (5, dt.datetime(2024, 2, 1, 10))
    assert json.loads(rows[1].raw_payload) == lines[0]
    assert (rows[2].employee_id, rows[2].start_date_utc) == (None, None)


def test_malformed_line_and_missing_file_fail(spark, folder):
    path = write(folder, "bad.jsonl", '{"id": 1}\n{broken\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        landing.activities(spark, path).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landing.activities(spark, f"{folder}/none.jsonl").collect()


def test_files_by_path(spark, folder):
    spark.range(5).write.parquet(f"{folder}/t")
    assert row_count(spark, f"{folder}/t").first().row_count == 5
    assert path_exists(spark, f"{folder}/t") and not path_exists(spark, f"{folder}/none")
    assert children(spark, f"{folder}/none") == [] and "_SUCCESS" in children(spark, f"{folder}/t")


def test_csv_columns_are_selected_by_name(spark, folder):
    path = write(folder, "x.csv", "b;a\n1;2\n")
    assert tuple(read_csv(spark, path, ["a", "b"], sep=";").first()) == ("2", "1")


def test_csv_lines_of_another_width_are_errors(spark, tmp_path):
    import pytest

    from lakekeel.sources.files import read_csv

    for name, line in (("long", "1,2,3"), ("short", "1")):
        (tmp_path / f"{name}.csv").write_text(f"a,b\n{line}\n")
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ|FAILFAST"):
            read_csv(spark, f"{tmp_path}/{name}.csv", ["a"]).collect()
