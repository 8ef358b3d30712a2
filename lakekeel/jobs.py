"""Entry points for spark-submit: ``land``, ``full-load``, ``cycle``, ``publish`` and ``notify``.

Operational tables come over JDBC (``--jdbc-url``) or as one lake folder per table
(``--tables``); topics from Kafka (``--bootstrap``) or as folders (``--topics``).
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from lakekeel import schemas
from lakekeel.operators.quality import require_new_keys
from lakekeel.plans import landing, serving
from lakekeel.plans.lake import Lake, full_load
from lakekeel.session import configure
from lakekeel.sources.files import append_lake, path_exists, read_lake
from lakekeel.sources.hashed import PARTS
from lakekeel.sources.relational import HASH, Database, hash_predicates, range_predicates
from lakekeel.sources.topics import FolderTopic, KafkaTopic, Topic
from lakekeel.streaming.cycle import IncrementalCycle, notified_log, run_notifications


#: Keys that a table has once.
KEYS = {"rh_employees": ["id"], "sport_activities": ["id"], "strava_activities": ["activity_id"]}
#: Numeric keys whose quantiles, and textual keys whose hash, split a database scan.
SPLIT_ON = {"rh_employees": "id", "sport_activities": "id", "strava_activities": "activity_id"}
HASH_ON = {"distance_cache": ("origin_address", "destination_address", "provider")}


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lakekeel")
    parser.add_argument("job", choices=["land", "full-load", "cycle", "publish", "notify"])
    parser.add_argument("--root", required=True, help="lake folder all executors reach")
    parser.add_argument("--destination", help="address commutes lead to")
    parser.add_argument("--as-of", help="day that counts as today")
    parser.add_argument("--tables", help="folder with one lake folder per operational table")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    parser.add_argument("--partitions", type=int, default=8, help="parallel key ranges of a table scan over JDBC")
    parser.add_argument("--jdbc-hash", default=HASH, help="the database's function from text to a whole number")
    parser.add_argument("--parts", type=int, default=PARTS, help="hash folders of what batches look up by key; stays as it was for a lake")
    parser.add_argument("--topics", help="folder with one folder per topic")
    parser.add_argument("--bootstrap", help="Kafka servers")
    parser.add_argument("--topic-prefix", default="", help="before the table name in change topic names")
    parser.add_argument("--answers", help="lake folder of provider answers (origin, destination, body)")
    parser.add_argument("--employee-csv")
    parser.add_argument("--sport-csv")
    parser.add_argument("--activity-json")
    parser.add_argument("--database", default="gold")
    parser.add_argument("--apply-deletes", action="store_true")
    parser.add_argument("--retry-failed", action="store_true", help="ask again for distances whose look-up failed")
    parser.add_argument("--strict", action="store_true", help="stop a load when a check fails")
    return parser


class _Job:
    def __init__(self, spark: SparkSession, options: argparse.Namespace):
        self.spark, self.options, self.lake = spark, options, Lake(spark, f"{options.root}/lake", parts=options.parts)

    def _database(self) -> Database:
        """User and password come from the environment, not from the command line."""
        names = {"user": "JDBC_USER", "password": "JDBC_PASSWORD"}
        secrets = {option: os.environ[name] for option, name in names.items() if name in os.environ}
        return Database(self.options.jdbc_url, {"driver": self.options.jdbc_driver, **secrets})

    def _table(self, name: str) -> DataFrame:
        if self.options.jdbc_url:
            return self._database().read_split(self.spark, name, self._predicates(name))
        return read_lake(self.spark, f"{self.options.tables}/{name}")

    def _predicates(self, name: str) -> list[str]:
        parts = self.options.partitions
        if name in HASH_ON:
            return hash_predicates(HASH_ON[name], parts, self.options.jdbc_hash)
        if name in SPLIT_ON and parts > 1:
            return range_predicates(SPLIT_ON[name], self._database().quantiles(self.spark, name, SPLIT_ON[name], parts))
        return []

    def _append(self, rows: DataFrame, name: str) -> None:
        if self.options.jdbc_url:
            self._database().append(rows, name)
        else:  # plain folders have no key constraint of their own
            path = f"{self.options.tables}/{name}"
            require_new_keys(rows, read_lake(self.spark, path) if path_exists(self.spark, path) else None, KEYS[name], name)
            append_lake(rows, path)

    def _topic(self, name: str, starting: str = "earliest") -> Topic:
        if self.options.bootstrap:
            return KafkaTopic(name, self.options.bootstrap, starting)
        return FolderTopic(f"{self.options.topics}/{name}")

    def _changes(self, table: str, starting: str = "earliest") -> Topic:
        return self._topic(f"{self.options.topic_prefix}{table}", starting)

    def _answer(self, requests: DataFrame) -> DataFrame:
        known = read_lake(self.spark, self.options.answers)
        return requests.join(known, ["origin_address", "destination_address"])

    def land(self) -> None:
        o, root = self.options, self.options.root
        landing.prepare_csv(self.spark, o.employee_csv, f"{root}/landing/employees", schemas.EMPLOYEE_HEADERS)
        landing.prepare_csv(self.spark, o.sport_csv, f"{root}/landing/sports", schemas.SPORT_HEADERS)
        landing.land_reference_data(
            self.spark, f"{root}/landing/employees", f"{root}/landing/sports", self._append
        )
        if o.activity_json:
            self._append(landing.activities(self.spark, o.activity_json), "strava_activities")

    def full_load(self) -> None:
        o = self.options
        requests = self._topic("distance_requests") if o.bootstrap or o.topics else None
        failed = full_load(self.lake, self._table, o.destination, o.as_of, o.strict, requests, o.retry_failed)
        for check in failed:
            print(f"failed check: {check}")

    def cycle(self) -> None:
        o = self.options
        IncrementalCycle(
            self.lake, f"{o.root}/checkpoints", o.destination,
            employees=self._changes("rh_employees"),
            sports=self._changes("sport_activities"),
            activities=self._changes("strava_activities"),
            requests=self._topic("distance_requests"),
            provider=self._answer if o.answers else None,
            as_of=o.as_of, apply_deletes=o.apply_deletes, retry_failed=o.retry_failed,
        ).run()

    def publish(self) -> None:
        location, database = f"{self.options.root}/gold", self.options.database
        serving.publish_bonus(self.lake.bonus_input.snapshot(), location, database)
        serving.publish_wellbeing(self.lake.wellbeing_of(self.options.as_of), location, database)

    def notify(self) -> None:
        run_notifications(
            self._changes("strava_activities", "latest"), self._topic("notifications"),
            self.lake.employees.snapshot, self.spark, f"{self.options.root}/checkpoints/notifications",
            notified_log(self.spark, f"{self.options.root}/notified", self.options.parts),
        )


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    options = _arguments().parse_args(arguments)
    spark = configure(spark or SparkSession.builder.appName(f"lakekeel {options.job}").getOrCreate())
    getattr(_Job(spark, options), options.job.replace("-", "_"))()


if __name__ == "__main__":
    main()
