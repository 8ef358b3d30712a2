from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from lakekeel import schemas
from lakekeel.jobs import main
from lakekeel.sources.topics import FolderTopic


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)


def test_from_landing_files_to_views_and_changes(spark, folder):
    people = ",".join(schemas.EMPLOYEE_HEADERS) + "\n" + "\n".join(
        f'{i},N{i},P{i},6/7/1990,B,14/12/2020,30000,CDI,25,"{i} Rue, 34000 X",Marche/running' for i in (1, 2)
    )
    write(f"{folder}/in/rh.csv", people)
    write(f"{folder}/in/sport.csv", ",".join(schemas.SPORT_HEADERS) + "\n1,Judo\n2,\n")
    write(f"{folder}/in/a.jsonl", "\n".join(
        json.dumps({"id": i, "athlete": {"id": 1}, "name": "S", "distance": 10, "start_date": "2024-02-01T10:00:00Z"}) for i in range(15)
    ))
    tables, topics = f"{folder}/tables", f"{folder}/topics"
    answers = [(f"{i} Rue, 34000 X", "D", '{"rows":[{"elements":[{"status":"OK","distance":{"value":9000},"duration":{"value":9}}]}]}') for i in (1, 2, 3)]
    spark.createDataFrame(answers, "origin_address string, destination_address string, body string").write.parquet(f"{folder}/answers")
    spark.createDataFrame([], schemas.DISTANCES).write.parquet(f"{tables}/distance_cache")
    common = ["--root", f"{folder}/root", "--tables", tables, "--topics", topics, "--destination", "D", "--as-of", "2024-06-30",
              "--database", "gold_jobs", "--answers", f"{folder}/answers"]
    main(["land", *common, "--employee-csv", f"{folder}/in/rh.csv", "--sport-csv", f"{folder}/in/sport.csv",
          "--activity-json", f"{folder}/in/a.jsonl"], spark)
    main(["full-load", *common, "--strict"], spark)
    main(["publish", *common], spark)
    assert spark.table("gold_jobs.v_wellbeing").first().nb_activities_year == 15
    assert {r.distance_km for r in spark.table("gold_jobs.v_prime_sportive").collect()} == {None}

    row = {"id": 2, "nom": "N2", "prenom": "P2", "business_unit": "B", "salaire_brut": 50000.0,
           "adresse_complete": "3 Rue, 34000 X", "moyen_deplacement": "Marche/running"}
    messages = {"rh_employees": {"op": "u", "after": row}, "sport_activities": {"op": "u", "after": {"id": 2, "pratique_sport": "Voile"}},
                "strava_activities": {"op": "c", "after": {"activity_id": 99, "employee_id": 2, "name": "run", "distance_m": 350,
                                                          "start_date_utc": "2024-03-01T00:00:00Z"}}}
    for name, message in messages.items():
        FolderTopic(f"{topics}/{name}").send(spark.createDataFrame([(json.dumps(message),)], "value string"))
    main(["cycle", *common], spark)
    main(["publish", *common], spark)
    bonus = {r.employee_id: (r.salaire_brut, r.distance_km) for r in spark.table("gold_jobs.v_prime_sportive").collect()}
    assert bonus == {1: (30000.0, 9.0), 2: (50000.0, 9.0)}
    assert {r.employee_id: r.nb_activities_year for r in spark.table("gold_jobs.v_wellbeing").collect()} == {1: 15, 2: 1}
    main(["notify", *common], spark)
    sent = FolderTopic(f"{topics}/notifications").read(spark).select(F.from_json("value", "employee_fullname string, distance_km double").alias("m"))
    assert [tuple(r) for r in sent.select("m.*").collect()] == [("P2 N2", 0.4)]
