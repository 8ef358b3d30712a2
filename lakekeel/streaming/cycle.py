"""Keeping the lake current from change topics, by micro-batch streams that drain and stop."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakekeel import schemas
from lakekeel.functions.temporal import reference_day
from lakekeel.operators.changes import BY_BATCH, DELETED, OP, SEQ, accepted, inserts, order_vector, parse_changes, rejected
from lakekeel.operators.upsert import latest_per_key
from lakekeel.plans import distance, gold, silver
from lakekeel.plans.lake import Lake, residents
from lakekeel.plans.notify import NOTIFIED, notification_messages, notifications
from lakekeel.session import together
from lakekeel.sources.hashed import BATCH, PARTS, HashedLog
from lakekeel.sources.tables import LakeTable
from lakekeel.sources.topics import Topic
from lakekeel.streaming.deltas import counted_whole

Handler = Callable[[DataFrame, int], None]


def start(stream: DataFrame, handler: Handler, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Start processing everything available. A restart continues from the checkpoint."""
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finish(*queries: StreamingQuery | None) -> None:
    """Wait for all queries, then raise what the first failed one raised."""
    failure = None
    for query in queries:
        try:
            if query:
                query.awaitTermination()
        except StreamingQueryException as error:
            failure = failure or error
    if failure:
        raise failure


def drain(stream: DataFrame, handler: Handler, checkpoint: str, mode: str = "append") -> None:
    finish(start(stream, handler, checkpoint, mode))


def batch_name(batch: DataFrame, name: str, batch_id: int) -> str:
    """A batch's name, tied to its checkpoint: ids start again with a new one, the stream's own id doesn't."""
    return f"{name}-{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"


PAIR = ["origin_address", "destination_address"]


def _addresses(ways: DataFrame) -> DataFrame:
    return ways.select(F.col("adresse_complete").alias("origin_address")).distinct()


@dataclass
class IncrementalCycle:
    """Change topics to bronze, silver and gold.

    ``provider`` turns requests (origin_address, destination_address) into answers
    (the same plus ``body``); without one, requests stay in their topic. A request
    it has no answer to stays open and is asked again in every run; one sent again
    after a failure is asked again too, and ``retry_failed`` sends it whenever the
    employee changes. Table
    writes are keyed by batch, so replaying a batch changes nothing; a request may
    be sent to Kafka again and is then answered from the cache.
    """

    lake: Lake
    checkpoints: str
    destination: str
    employees: Topic
    sports: Topic
    activities: Topic
    requests: Topic
    provider: Callable[[DataFrame], DataFrame] | None = None
    as_of: dt.date | str | None = None
    apply_deletes: bool = False
    retry_failed: bool = False
    compact_after: int = 16

    def run(self) -> None:
        """One pass over all streams. Those that share no table run at the same time."""
        finish(self.start_employees(), self.start_sports(), self.start_activities())
        self.process_open_requests()
        finish(self.start_requests() if self.provider else None, self.start_wellbeing())
        self.lake.compact(self.compact_after)

    def start_employees(self) -> StreamingQuery:
        return self._start(self.employees, "rh_employees", self._apply_employees)

    def start_sports(self) -> StreamingQuery:
        return self._start(self.sports, "sport_activities", self._apply_sports)

    def start_activities(self) -> StreamingQuery:
        return self._start(self.activities, "strava_activities", self._apply_activities)

    def start_requests(self) -> StreamingQuery:
        return self._start(self.requests, "distance_requests", self._apply_answers, held=True)

    def start_wellbeing(self) -> StreamingQuery | None:
        if not self.lake.activity.exists():
            return None
        return start(self.lake.activity.change_stream(), self._apply_wellbeing, f"{self.checkpoints}/wellbeing")

    def process_employees(self) -> None:
        finish(self.start_employees())

    def process_sports(self) -> None:
        finish(self.start_sports())

    def process_activities(self) -> None:
        finish(self.start_activities())

    def process_requests(self) -> None:
        finish(self.start_requests())

    def process_open_requests(self) -> None:
        """Ask again what had no answer. Requests stay open until the last write of a run that answers them."""
        if self.provider and self.lake.open_requests.exists():
            wanted = self.lake.open_requests.snapshot()
            if not wanted.isEmpty():
                self._answer(wanted, f"open-{uuid.uuid4().hex}")

    def process_wellbeing(self) -> None:
        finish(self.start_wellbeing())

    def _start(
        self, topic: Topic, name: str, apply: Callable[[DataFrame, str], None], held: bool = False
    ) -> StreamingQuery:
        """``held`` keeps a batch's messages for a handler that reads them more than once."""
        def handler(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist() if held else batch
            try:
                if not batch.isEmpty():
                    apply(batch, batch_name(batch, name, batch_id))
            finally:
                batch.unpersist()

        return start(topic.stream(self.lake.spark), handler, f"{self.checkpoints}/{name}")

    def _bronze(self, batch: DataFrame, table: LakeTable, schema: str, name: str) -> DataFrame:
        """Write the batch's newest row per key to bronze and set unreadable messages aside.

        Messages that say nothing about their order count in order of arrival.
        """
        parsed = parse_changes(batch, schema, table.keys, ordered=True, deletes=self.apply_deletes)
        parsed = parsed.withColumn(SEQ, F.coalesce(SEQ, order_vector(BY_BATCH, F.lit(table.generation(name)))))
        # Parsed once for both; the text of a message is kept only where it is set aside.
        parsed = parsed.withColumn("_value", F.when(F.col("_reason").isNotNull(), F.col("_value"))).persist()
        try:
            rows = table.apply(accepted(parsed, self.apply_deletes), name)
            rejected(parsed).write.mode("overwrite").json(f"{self.lake.root}/quarantine/{name}")
            return rows
        finally:
            parsed.unpersist()

    def _apply_employees(self, batch: DataFrame, name: str) -> None:
        lake = self.lake
        rows = self._bronze(batch, lake.employees, schemas.EMPLOYEES, name)
        ways = silver.commute(rows)
        cache = lake.distances.versioned(within=_addresses(ways))
        wanted = distance.missing_requests(ways.filter(~F.col(DELETED)), cache, self.destination, self.retry_failed)
        stamped = distance.stamped_commute(ways, cache, self.destination)
        people, ways, _, _ = together(
            partial(lake.employee.apply, silver.employee(rows, self.as_of), name, resolved=True),
            partial(lake.commute.apply, stamped, name, resolved=True),
            partial(self.requests.send, distance.request_messages(wanted), name),
            partial(lake.known_residents().append, residents(ways), lake.commute.generation(name)),
        )
        lake.bonus_input.apply(gold.bonus_input(people, ways, self.as_of), name, resolved=True)

    def _apply_answers(self, batch: DataFrame, name: str) -> None:
        """Answer the requests to which the cache holds no success yet."""
        wanted, cache = distance.parse_requests(batch), self.lake.distances
        if cache.exists():
            earlier = cache.versioned(within=wanted.select(*PAIR)).filter(
                (F.col(SEQ) < cache.generation(name)) & (F.col("provider") == distance.DEFAULT_PROVIDER)
                & (F.col("status") == distance.OK)
            )
            wanted = wanted.join(earlier.select(*PAIR), PAIR, "left_anti")
        self._answer(wanted, name)

    def _answer(self, wanted: DataFrame, name: str) -> None:
        """Ask the provider, then bring commutes and bonus inputs at the answered addresses up to date."""
        lake = self.lake
        generation = lake.distances.generation(name)
        answered = distance.answers(self.provider(wanted))
        stamped = answered.withColumns({SEQ: F.lit(generation), "last_updated": F.current_timestamp()})
        cached = lake.distances.apply(stamped, name)
        addresses = cached.select(F.col("origin_address").alias("adresse_complete")).distinct()
        lived_at = lake.known_residents().read(addresses).select("employee_id").distinct()
        ways = lake.commute.versioned(within=lived_at).drop(*distance.MEASURES, "_cache_seq")
        ways = distance.stamped_commute(ways, cached, self.destination).filter(F.col("_cache_seq") == generation)
        ways = lake.commute.apply(ways, name, resolved=True)
        people = lake.employee.snapshot(within=ways.select("employee_id"))
        lake.bonus_input.apply(gold.bonus_input(people, ways, self.as_of), name, resolved=True)
        found = cached.select(*PAIR, F.lit(True).alias(DELETED)).distinct()
        state = wanted.select(*PAIR).join(found, PAIR, "left").withColumns(
            {DELETED: F.coalesce(DELETED, F.lit(False)), SEQ: F.lit(lake.open_requests.generation(name))}
        )
        lake.open_requests.apply(state, name, resolved=True)

    def _apply_sports(self, batch: DataFrame, name: str) -> None:
        rows = self._bronze(batch, self.lake.sports, schemas.SPORTS, name)
        self.lake.sport_profile.apply(silver.sport_profile(rows), name, resolved=True)

    def _apply_activities(self, batch: DataFrame, name: str) -> None:
        rows = self._bronze(batch, self.lake.activities, schemas.ACTIVITIES, name)
        self.lake.activity.apply(silver.activity(rows), name, resolved=True)

    def _apply_wellbeing(self, batch: DataFrame, batch_id: int) -> None:
        """Bring the counts of every (employee, year) up to date that the changed activities belong or belonged to.

        Signed changes follow from the images of the batch's own activities, so
        updates, moves between years or employees and repeated batches are exact
        and other activities aren't read. A pair left without activities goes.
        Where there are no images yet, all activities are counted once.
        """
        if batch.isEmpty():
            return
        lake = self.lake
        name = batch_name(batch, "wellbeing", batch_id)
        number = lake.wellbeing.generation(name)
        if not lake.signed.exists():
            # The days come last: without them the first build is taken up again.
            lake.signed.seed_images(lake.activity.versioned())
            lake.wellbeing.replace(counted_whole(lake.signed.imaged_activities()))
            lake.signed.seed_days()
            return
        touched = lake.signed.apply(batch, number)
        recounted = touched.join(lake.signed.counts(touched), ["_who", "year"], "left").withColumns(
            {DELETED: F.col("nb_activities_year").isNull(), SEQ: F.lit(number)}
        )
        lake.wellbeing.apply(recounted, name, resolved=True)


def run_wellbeing_totals(
    changes: DataFrame, target: LakeTable, checkpoint: str, as_of: dt.date | str | None = None
) -> None:
    """Stateful alternative for insert-only activities: running totals, written anew each batch.

    ``target`` is a keyed lake table's folder: a batch is a new base, which counts once its job committed.

    Activities that come again are counted once. State grows with the number of
    activities of the year; where rows change later, :class:`IncrementalCycle` recounts instead.
    """
    current = changes.filter(F.col("activity_year") == F.year(reference_day(as_of)))
    totals = gold.wellbeing_counts(current.dropDuplicates(["activity_id"]), as_of)

    def replace(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            target.replace(batch)

    drain(totals, replace, checkpoint, mode="complete")


def run_wellbeing_updates(
    changes: DataFrame, target: LakeTable, checkpoint: str, as_of: dt.date | str | None = None
) -> None:
    """As :func:`run_wellbeing_totals`, but only groups that a batch changed are written, as one batch of ``target``.

    The grouped state holds every total; update mode hands out the changed ones,
    and the target keeps the newest row of each group.
    """
    current = changes.filter(F.col("activity_year") == F.year(reference_day(as_of)))
    totals = gold.wellbeing_counts(current.dropDuplicates(["activity_id"]), as_of)

    def merge(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            name = batch_name(batch, "totals", batch_id)
            target.apply(batch.withColumn(SEQ, F.lit(target.generation(name))), name, resolved=True)

    drain(totals, merge, checkpoint, mode="update")


def run_notifications(
    topic: Topic,
    outbox: Topic,
    employees: Callable[[], DataFrame],
    spark: SparkSession,
    checkpoint: str,
    notified: HashedLog | None = None,
) -> None:
    """New activities to notification messages; employees are read anew for every batch.

    With ``notified``, a log of the activities told of, an activity is told of
    once, however often its creation is delivered, also under a renewed
    checkpoint; a batch that comes again sends what it had sent.
    """

    def send(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch, "notifications", batch_id)
        keys = ["activity_id"] if notified else []
        created = inserts(parse_changes(batch, NOTIFIED, keys, ordered=bool(notified)))
        if not notified:
            outbox.send(notification_messages(notifications(created, employees())), name)
            return
        number = named_number(name)
        # Parsed and told apart once; the look-up, the outbox and the log all read that.
        created = latest_per_key(created.drop(OP, DELETED), keys, [SEQ]).drop(SEQ).persist()
        fresh = created
        try:
            if notified.exists():
                earlier = notified.beside(created).filter(F.col(BATCH) != number)
                fresh = created.join(earlier.select(*keys), keys, "left_anti").persist()
            outbox.send(notification_messages(notifications(fresh, employees())), name)
            notified.append(fresh.select(*keys), number)
        finally:
            fresh.unpersist()
            created.unpersist()

    drain(topic.stream(spark), send, checkpoint)


def named_number(name: str) -> int:
    """A number for a batch's name, the same whenever it is sent."""
    return int.from_bytes(hashlib.sha256(name.encode()).digest()[:7])


def notified_log(spark: SparkSession, path: str, parts: int = PARTS) -> HashedLog:
    """The activities told of, for :func:`run_notifications`."""
    return HashedLog(spark, path, "activity_id bigint", ["activity_id"], parts)
