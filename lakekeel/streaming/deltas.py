"""A change feed with before and after images, and yearly counts kept by signed changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakekeel.operators.changes import DELETED, SEQ
from lakekeel.plans.gold import wellbeing_counts
from lakekeel.sources.hashed import PARTS, HashedLog

#: What a count depends on of an activity. A missing employee is a group of its own, so ``_who`` is never NULL.
_IMAGE = "_who string, employee_id int, year int, day date"
_GROUP = ["_who", "employee_id", "year"]


def _who() -> F.Column:
    return F.coalesce(F.col("employee_id").cast("string"), F.lit(""))


class SignedCounts:
    """Activities per employee and year, maintained by +1 and -1.

    ``images`` logs what each activity counted for, by activity; ``days`` logs
    signed numbers by employee and day. A batch looks up the images of its own
    activities, and nothing else of the activities is read: a move takes one
    from the old group and adds one to the new, a delete only takes. Counts,
    first and last day of a group follow from its days, at most 366 a year, so
    losing the first or last activity needs no look at the others.

    Batches have rising numbers. One that comes again finds only the images
    before it and replaces its own days, so it changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, parts: int = PARTS):
        self.images = HashedLog(
            spark, f"{root}/images", f"activity_id bigint, {_IMAGE}, {SEQ} decimal(38,0), {DELETED} boolean", ["activity_id"], parts
        )
        self.days = HashedLog(spark, f"{root}/days", f"{_IMAGE}, n bigint", ["_who"], parts)

    def exists(self) -> bool:
        return self.images.exists() and self.days.exists()

    def _imaged(self, activities: DataFrame) -> DataFrame:
        return activities.select(
            "activity_id", _who().alias("_who"), "employee_id", F.col("activity_year").alias("year"), F.col("activity_date").alias("day"),
            F.col(SEQ).cast("decimal(38,0)").alias(SEQ), F.col(DELETED) if DELETED in activities.columns else F.lit(False).alias(DELETED),
        )

    def seed(self, activities: DataFrame) -> None:
        """Start from current activities, one row per id."""
        self.seed_images(activities)
        self.seed_days()

    def seed_images(self, activities: DataFrame) -> None:
        """The first half: merged once, the activities are read as images from then on."""
        self.images.replace(self._imaged(activities))

    def imaged_activities(self) -> DataFrame:
        """What was seeded, as activities again: of each what a count depends on."""
        return self.images.read().select("activity_id", "employee_id", F.col("year").alias("activity_year"), F.col("day").alias("activity_date"))

    def seed_days(self) -> None:
        self.days.replace(_netted(self.images.read().withColumn("sign", F.lit(1))))

    def feed(self, activities: DataFrame, batch: int) -> DataFrame:
        """``activity_id, before, after``: what each changed activity counted for before the batch, and after it.

        Of several rows of an activity the newest counts, and a row older than the known image changes nothing.
        """
        new = self._imaged(activities)
        known = self.images.beside(new, before=batch).select(*new.columns)
        both = known.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
        image = F.struct(SEQ, DELETED, "_who", "employee_id", "year", "day")
        found = both.groupBy("activity_id").agg(F.max(F.when(~F.col("_new"), image)).alias("before"), F.max(image).alias("after"), F.max("_new").alias("_new"))
        return found.filter("_new").drop("_new").filter(~F.col("before").eqNullSafe(F.col("after")))

    def apply(self, activities: DataFrame, batch: int) -> DataFrame:
        """Log a batch; returns ``_who, year`` of every group whose count it changed."""
        signed = self.feed(activities, batch).select(
            F.inline(F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("image")), F.struct(F.lit(1).alias("sign"), F.col("after").alias("image"))))
        )
        rows = signed.filter(F.col("image").isNotNull() & ~F.col(f"image.{DELETED}")).select("image.*", "sign")
        self.days.append(_netted(rows), batch)
        self.images.append(self._imaged(activities), batch)
        return self.days.read(batch=batch).select("_who", "year").distinct()

    def counts(self, touched: DataFrame) -> DataFrame:
        """``_who``, employee, year, number, first and last day of the touched groups; those without any left are absent."""
        days = self.days.read(touched.select("_who").distinct()).join(touched, ["_who", "year"], "left_semi")
        held = days.groupBy(*_GROUP, "day").agg(F.sum("n").alias("n")).filter("n > 0")
        return held.groupBy(*_GROUP).agg(
            F.sum("n").alias("nb_activities_year"), F.min("day").alias("first_activity_date"), F.max("day").alias("last_activity_date")
        )

    def fold(self, after: int = 16) -> None:
        """Few files again: the newest image of each activity, the net number of each day."""
        image = F.struct(SEQ, DELETED, "_who", "employee_id", "year", "day")
        self.images.fold(lambda rows: rows.groupBy("activity_id").agg(F.max(image).alias("i")).select("activity_id", "i.*"), after)
        self.days.fold(lambda rows: _netted(rows.withColumnRenamed("n", "sign")), after)


def _netted(signed: DataFrame) -> DataFrame:
    """Signed rows added up per group and day; what cancels out is gone, and so is what has no year."""
    return signed.filter("year IS NOT NULL").groupBy(*_GROUP, "day").agg(F.sum("sign").cast("bigint").alias("n")).filter("n <> 0")


def counted_whole(activities: DataFrame) -> DataFrame:
    """The same counts of all activities, for a first build."""
    return wellbeing_counts(activities, all_years=True).withColumn("_who", _who())
