"""Commute distances: cache look-up, requests for what is missing, provider answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakekeel.operators.joins import lookup_join
from lakekeel.schemas import PROVIDER_ANSWER

# Default provider of a cache row and the status of a usable one.
DEFAULT_PROVIDER = "google_maps"
OK = "OK"
MEASURES = ("distance_domicile_travail_m", "duree_domicile_travail_s")
CACHE_KEYS = ("origin_address", "destination_address", "provider")


def enriched_commute(
    commutes: DataFrame, cache: DataFrame, destination: str, provider: str = DEFAULT_PROVIDER
) -> DataFrame:
    """Commutes with distance and duration to ``destination``; NULL where none is known.

    The cache holds one row per origin, destination and provider, so fixing the
    last two leaves one per address and the join cannot multiply employees.
    """
    known = cache.filter(
        (F.col("destination_address") == destination) & (F.col("provider") == provider) & (F.col("status") == OK)
    ).select(
        F.col("origin_address").alias("adresse_complete"),
        F.col("distance_m").alias(MEASURES[0]),
        F.col("duration_s").alias(MEASURES[1]),
    )
    return _in_order(lookup_join(commutes, known, ["adresse_complete"]), commutes)


def stamped_commute(
    commutes: DataFrame, cache: DataFrame, destination: str, provider: str = DEFAULT_PROVIDER
) -> DataFrame:
    """As :func:`enriched_commute`, plus ``_cache_seq``: the version of the cache row looked at.

    Rows that are not OK count as looked at, so that a failure which replaces a
    success takes effect. -1 where the cache has no row.
    """
    usable = F.col("status") == OK
    known = cache.filter(
        (F.col("destination_address") == destination) & (F.col("provider") == provider)
    ).select(
        F.col("origin_address").alias("adresse_complete"),
        F.when(usable, F.col("distance_m")).alias(MEASURES[0]),
        F.when(usable, F.col("duration_s")).alias(MEASURES[1]),
        F.col("_seq").alias("_cache_seq"),
    )
    joined = _in_order(lookup_join(commutes, known, ["adresse_complete"]), commutes)
    return joined.withColumn("_cache_seq", F.coalesce("_cache_seq", F.lit(-1)))


def _in_order(joined: DataFrame, commutes: DataFrame) -> DataFrame:
    added = [c for c in joined.columns if c not in commutes.columns]
    return joined.select(*commutes.columns, *added)


def missing_requests(
    commutes: DataFrame, cache: DataFrame, destination: str, retry_failed: bool = False, provider: str = DEFAULT_PROVIDER
) -> DataFrame:
    """Address pairs the cache does not hold from this provider, each once; a failed look-up counts as held.

    With ``retry_failed`` only successful ones do. Addresses that are NULL cannot
    be looked up and are left out.
    """
    known = cache.filter((F.col("destination_address") == destination) & (F.col("provider") == provider))
    if retry_failed:
        known = known.filter(F.col("status") == OK)
    return (
        commutes.filter(F.col("adresse_complete").isNotNull())
        .select(F.col("adresse_complete").alias("origin_address"))
        .distinct()
        .join(known.select("origin_address"), "origin_address", "left_anti")
        .withColumn("destination_address", F.lit(destination))
    )


def request_messages(requests: DataFrame) -> DataFrame:
    return requests.select(F.to_json(F.struct("origin_address", "destination_address")).alias("value"))


def parse_requests(messages: DataFrame) -> DataFrame:
    """Requests from topic messages, each pair once; unreadable ones are dropped."""
    request = F.from_json(F.col("value").cast("string"), "origin_address string, destination_address string")
    return (
        messages.select(request.alias("r")).select("r.*").na.drop().distinct()
    )


def answers(responses: DataFrame, provider: str = DEFAULT_PROVIDER) -> DataFrame:
    """Cache rows from provider bodies: ``origin_address, destination_address, body`` in.

    A body that is not OK gives NULL measures and its status; one that lacks an
    expected part gives the status ``ERROR: <what is missing>``.
    """
    parsed = responses.withColumn("_b", F.from_json("body", PROVIDER_ANSWER)).withColumn(
        "_e", F.get(F.get("_b.rows", F.lit(0))["elements"], F.lit(0))
    )
    elements = F.get("_b.rows", F.lit(0))["elements"]
    # Error texts of unexpected bodies.
    error = (
        F.when(F.col("_b.rows").isNull(), "'rows'")
        .when(F.size("_b.rows") == 0, "list index out of range")
        .when(elements.isNull(), "'elements'")
        .when(F.size(elements) == 0, "list index out of range")
        .when(F.col("_e.status").isNull(), "'status'")
        .when(F.col("_e.status") != OK, F.lit(None))
        .when(F.col("_e.distance").isNull(), "'distance'")
        .when(F.col("_e.distance.value").isNull(), "'value'")
        .when(F.col("_e.duration").isNull(), "'duration'")
        .when(F.col("_e.duration.value").isNull(), "'value'")
    )
    judged = parsed.withColumn("_s", F.coalesce(F.concat(F.lit("ERROR: "), error), F.col("_e.status")))
    usable = F.col("_s") == OK
    return judged.select(
        "origin_address",
        "destination_address",
        F.when(usable, F.col("_e.distance.value")).alias("distance_m"),
        F.when(usable, F.col("_e.duration.value")).alias("duration_s"),
        F.lit(provider).alias("provider"),
        F.col("_s").alias("status"),
        F.when(~usable, F.col("_s")).alias("error_message"),
        *[c for c in responses.columns if c.startswith("_")],
    )
