"""Operational tables, change topics and provider bodies derived from the generic test tables.

Each function reads whole tables and stays lazy; ``oracles.py`` holds the same
mappings in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AS_OF = "2024-06-30"
DESTINATION = "1 Place du Marché, 34000 Montpellier"
OTHER_DESTINATION = "2 Quai Nord, 34200 Sète"
OTHER_PROVIDER = "other_maps"
NO_POSTCODE = "Chemin des Dunes, Mireval"
MODES = (
    " Marche/running ",
    "VÉLO/Trottinette/Autres",
    "Transports en commun",
    "véhicule thermique/électrique",
)
PRACTICES = (
    "Runing", "Randonnée", "Triathlon", "Natation", "Tennis", "Badminton", "Tennis de table",
    "Football", "Basketball", "Rugby", "Boxe", "Judo", "Escalade", "Équitation", "Pétanque",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choice(options: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), (index % len(options)).cast("int") + 1)


def _street(key: Column, nation: Column) -> Column:
    return F.concat(
        (key % 400).cast("string"), F.lit(" Quai Bleu, "), (30000 + nation * 17).cast("string"),
        F.lit(" Ville "), nation.cast("string"),
    )


def _address(key: Column, nation: Column) -> Column:
    return (
        F.when(key % 97 == 5, F.lit(None))
        .when(key % 50 == 7, F.lit(NO_POSTCODE))
        .otherwise(_street(key, nation))
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.cast("int").alias("id"),
        F.col("c_name").alias("nom"),
        F.concat(F.lit("P"), key.cast("string")).alias("prenom"),
        F.date_add(F.lit("1960-01-01").cast("date"), (key * 37 % 17500).cast("int")).alias("date_naissance"),
        F.date_add(F.lit("2015-01-01").cast("date"), (key * 13 % 3400).cast("int")).alias("date_embauche"),
        F.col("c_mktsegment").alias("business_unit"),
        (F.lit(20000) + F.floor(F.abs("c_acctbal")) * 5).cast("double").alias("salaire_brut"),
        F.when(key % 10 == 0, "CDD").otherwise("CDI").alias("contrat"),
        (F.lit(25) + key % 5).cast("int").alias("nb_conges_payes"),
        _address(key, F.col("c_nationkey")).alias("adresse_complete"),
        _choice(MODES, key).alias("moyen_deplacement"),
    )


def sports(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    practice = F.when(key % 5 == 1, "").when(key % 5 > 1, _choice(PRACTICES, key))
    return table(spark, sf_dir, "customer").select(key.cast("int").alias("id"), practice.alias("pratique_sport"))


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    start = F.col("ts").cast("timestamp")
    event = F.col("event_id")
    metres = F.floor(F.col("value") * 1000).cast("int")
    return e.select(
        event.alias("activity_id"),
        F.col("user_id").cast("int").alias("employee_id"),
        F.concat(F.lit("Session "), event.cast("string")).alias("name"),
        metres.alias("distance_m"),
        (600 + event % 7200).cast("int").alias("moving_time_s"),
        (660 + event % 7200).cast("int").alias("elapsed_time_s"),
        (event % 800).cast("int").alias("total_elev_gain_m"),
        F.when(event % 2 == 0, "Run").otherwise("Ride").alias("type"),
        F.when(event % 2 == 0, "Run").otherwise("EBikeRide").alias("sport_type"),
        start.alias("start_date_utc"),
        F.timestamp_add("SECOND", F.lit(3600), start).alias("start_date_local"),
        F.lit("(GMT+01:00) Europe/Paris").alias("timezone"),
        F.lit(3600).alias("utc_offset_s"),
        (event % 3 == 0).alias("commute"),
        F.lit(True).alias("manual"),
        F.lit(False).alias("private"),
        F.lit(False).alias("flagged"),
        F.floor(metres / 25).cast("int").alias("calories"),
        F.col("props").alias("raw_payload"),
        start.alias("created_at"),
    )


def _measured(c: DataFrame) -> DataFrame:
    """One cache row per distinct address of ``c`` to the main destination."""
    nation, street = F.col("c_nationkey"), F.col("c_custkey") % 400
    ok = nation % 7 != 3
    metres = ((nation * 1237 + street * 61) % 40000).cast("int")
    return c.select(
        _street(F.col("c_custkey"), nation).alias("origin_address"),
        F.lit(DESTINATION).alias("destination_address"),
        F.when(ok, metres).alias("distance_m"),
        F.when(ok, F.floor(metres / 10).cast("int")).alias("duration_s"),
        F.lit("google_maps").alias("provider"),
        F.when(ok, "OK").otherwise("ZERO_RESULTS").alias("status"),
        F.when(~ok, "ZERO_RESULTS").alias("error_message"),
    ).distinct()


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache before any request: some addresses missing, some with further destinations or providers."""
    c = table(spark, sf_dir, "customer").filter(F.col("c_nationkey") % 5 != 2)
    main = _measured(c)
    elsewhere = _measured(c.filter(F.col("c_nationkey") % 4 == 0)).withColumns(
        {"destination_address": F.lit(OTHER_DESTINATION), "distance_m": F.lit(1), "status": F.lit("OK")}
    )
    otherwise = _measured(c.filter(F.col("c_nationkey") % 4 == 1)).withColumns(
        {"provider": F.lit(OTHER_PROVIDER), "distance_m": F.lit(2), "status": F.lit("OK")}
    )
    return main.unionByName(elsewhere).unionByName(otherwise).withColumn(
        "last_updated", F.lit("2024-01-01").cast("timestamp")
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider body for every street address: usable, not OK, incomplete or not JSON at all."""
    c = table(spark, sf_dir, "customer")
    rows = _measured(c).select(
        "origin_address",
        "destination_address",
        (F.substring_index("origin_address", " ", 1).cast("int") % 10).alias("kind"),
        F.coalesce("distance_m", F.lit(0)).cast("string").alias("metres"),
        F.coalesce("duration_s", F.lit(0)).cast("string").alias("seconds"),
        "status",
    )
    body = (
        F.when(F.col("kind") == 0, "<html>busy</html>")
        .when(F.col("kind") == 1, '{"rows":[]}')
        .when(F.col("kind") == 2, '{"rows":[{"elements":[{"status":"OK"}]}]}')
        .when(F.col("kind") == 3, '{"error":"denied"}')
        .when(F.col("status") != "OK", F.concat(F.lit('{"rows":[{"elements":[{"status":"'), "status", F.lit('"}]}]}')))
        .otherwise(F.concat(
            F.lit('{"rows":[{"elements":[{"status":"OK","distance":{"value":'), "metres",
            F.lit('},"duration":{"value":'), "seconds", F.lit("}}]}]}"),
        ))
    )
    return rows.select("origin_address", "destination_address", body.alias("body"))


def answer(spark: SparkSession, sf_dir: str):
    """A provider that answers requests from :func:`responses`."""
    known = responses(spark, sf_dir)
    return lambda wanted: wanted.join(known, ["origin_address", "destination_address"])


def _epoch_days(column: str) -> Column:
    return F.unix_date(F.col(column)).cast("bigint")


def _message(op: Column, after: Column, seq: Column, bare: Column) -> Column:
    """Change envelope; the record stands bare or under ``payload``."""
    record = F.to_json(F.struct(op.alias("op"), after.alias("after"), F.struct(seq.alias("lsn")).alias("source")))
    opening, closing = F.when(bare, "").otherwise('{"payload":'), F.when(bare, "").otherwise("}")
    return F.concat(opening, record, closing)


def employee_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, op, seq and row of every change: first reads, moves, late old rows and deletes."""
    key = F.col("id")
    rows = employees(spark, sf_dir)
    moved = rows.filter(key % 3 == 0).withColumns({
        "adresse_complete": _street(key + 1, key % 25),
        "moyen_deplacement": _choice(MODES, key + 1),
        "op": F.lit("u"), "seq": key.cast("bigint") * 10 + 5,
    })
    old = rows.filter(key % 11 == 0).withColumns({
        "salaire_brut": F.lit(1.0), "op": F.lit("u"), "seq": key.cast("bigint") * 10 - 5,
    })
    deleted = rows.filter(key % 13 == 0).withColumns({"op": F.lit("d"), "seq": key.cast("bigint") * 10 + 7})
    first = rows.withColumns({"op": F.lit("r"), "seq": key.cast("bigint") * 10})
    return first.unionByName(moved).unionByName(old).unionByName(deleted)


def employee_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = employee_log(spark, sf_dir)
    columns = [c for c in log.columns if c not in ("op", "seq")]
    log = log.withColumns({c: _epoch_days(c) for c in ("date_naissance", "date_embauche")})
    after = F.when(F.col("op") != "d", F.struct(*columns))
    good = log.select(_message(F.col("op"), after, F.col("seq"), F.col("id") % 7 == 0).alias("value"))
    broken = log.filter(F.col("id") % 17 == 0).select(F.concat(F.lit("{broken "), "nom").alias("value"))
    return good.unionByName(broken)


def sport_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sports(spark, sf_dir)
    changed = rows.filter(F.col("id") % 4 == 0).withColumns({"pratique_sport": F.lit("Voile"), "seq": F.lit(2)})
    log = rows.withColumn("seq", F.lit(1)).unionByName(changed)
    after = F.struct("id", "pratique_sport")
    return log.select(_message(F.lit("u"), after, F.col("seq"), F.col("id") % 5 == 0).alias("value"))


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change of an activity: creation, moves to the next employee and to the year before, late old rows."""
    rows = activities(spark, sf_dir)
    key, seq = F.col("activity_id"), F.col("activity_id") * 10
    last = F.timestamp_add("DAY", F.lit(-366), F.col("start_date_utc"))
    changed = rows.filter(key % 6 == 0).withColumns({
        "employee_id": F.col("employee_id") + 1, "created_at": F.timestamp_add("DAY", F.lit(1), F.col("created_at")),
        "op": F.lit("u"), "seq": seq + 4,
    })
    moved = rows.filter(key % 10 == 0).withColumns({"start_date_utc": last, "op": F.lit("u"), "seq": seq + 5})
    old = rows.filter(key % 14 == 0).withColumns({"distance_m": F.lit(-1), "op": F.lit("u"), "seq": seq - 5})
    return rows.withColumns({"op": F.lit("c"), "seq": seq}).unionByName(changed).unionByName(moved).unionByName(old)


def activity_messages(spark: SparkSession, sf_dir: str, op: str | None = None) -> DataFrame:
    """Instants travel as epoch microseconds or as ISO text; some are neither. ``op`` leaves out other operations."""
    log = activity_log(spark, sf_dir)
    log = log.filter(F.col("op") == op) if op else log
    columns = [c for c in log.columns if c not in ("op", "seq")]
    key = F.col("activity_id")

    def sent(name: str) -> Column:
        iso = F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        return F.when(key % 2 == 0, F.unix_micros(F.col(name)).cast("string")).otherwise(iso)

    instants = {c: sent(c) for c in ("start_date_utc", "start_date_local", "created_at")}
    wire = log.withColumns(instants)
    after = F.struct(*columns)
    good = wire.select(_message(F.col("op"), after, F.col("seq"), key % 7 == 0).alias("value"))
    unreadable = wire.filter(key % 9 == 0).withColumn("start_date_utc", F.lit("soon"))
    bad = unreadable.select(_message(F.col("op"), after, F.col("seq") + 9, key % 7 == 0).alias("value"))
    return good.unionByName(bad)


def activity_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes of every 15th activity after its other changes; the row stands under ``before``."""
    rows = activities(spark, sf_dir).filter(F.col("activity_id") % 15 == 0)
    before = F.struct("activity_id", "employee_id")
    record = F.struct(F.lit("d").alias("op"), before.alias("before"), F.struct((F.col("activity_id") * 10 + 8).alias("lsn")).alias("source"))
    return rows.select(F.to_json(record).alias("value"))


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that tell their order in different ways: log positions (small numbers), event times (large ones) or not at all.

    Every 50th message has no key.
    """
    log = activity_log(spark, sf_dir)
    key, seq, logged = F.col("activity_id"), F.col("seq"), (F.col("op") == "u") & (F.col("seq") % 10 != 5)
    logged = logged | ((F.col("op") == "u") & (F.col("distance_m") != -1))
    time = F.lit(1_700_000_000_000) + seq + F.when(F.col("distance_m") == -1, 9_000_000_000).otherwise(0)
    shown = log.select("op", "activity_id", "employee_id", "distance_m", F.unix_micros("start_date_utc").cast("string").alias("start_date_utc"), F.when(logged, seq).alias("lsn"), F.when(~logged, time).alias("ts_ms"))
    silent = shown.filter((F.col("op") == "c") & (key % 5 == 3)).withColumns({"op": F.lit("r"), "distance_m": F.lit(-2), "lsn": F.lit(None).cast("bigint"), "ts_ms": F.lit(None).cast("bigint")})
    nameless = shown.filter((F.col("op") == "c") & (key % 50 == 1)).withColumn("activity_id", F.lit(None).cast("bigint"))
    after = F.struct("activity_id", "employee_id", "distance_m", "start_date_utc")
    record = F.to_json(F.struct("op", after.alias("after"), F.struct("lsn").alias("source"), "ts_ms"))
    return shown.unionByName(silent).unionByName(nameless).select(record.alias("value"))


def landing_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees under the display headers of a landing file, dates day first without padding."""
    from lakekeel.schemas import EMPLOYEE_HEADERS

    rows = employees(spark, sf_dir).withColumns({
        "id": F.col("id") + 1,
        "date_naissance": F.date_format("date_naissance", "d/M/yyyy"),
        "date_embauche": F.date_format("date_embauche", "d/M/yyyy"),
        "salaire_brut": F.col("salaire_brut").cast("bigint"),
    })
    return rows.select(*[F.col(name).alias(header) for header, name in EMPLOYEE_HEADERS.items()])


def landing_sports(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakekeel.schemas import SPORT_HEADERS

    rows = sports(spark, sf_dir).withColumn("id", F.col("id") + 1)
    return rows.select(*[F.col(name).alias(header) for header, name in SPORT_HEADERS.items()])


def activity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities as nested documents; some without an athlete, some with an unreadable start."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    key = F.col("activity_id")
    return activities(spark, sf_dir).select(
        key.alias("id"),
        F.when(key % 8 != 0, F.struct(F.col("employee_id").alias("id"), F.lit(1).alias("resource_state"))).alias("athlete"),
        "name",
        F.col("distance_m").alias("distance"),
        F.col("moving_time_s").alias("moving_time"),
        F.col("elapsed_time_s").alias("elapsed_time"),
        F.col("total_elev_gain_m").alias("total_elevation_gain"),
        "type",
        "sport_type",
        F.when(key % 12 == 0, "unknown").otherwise(F.date_format("start_date_utc", iso)).alias("start_date"),
        F.date_format("start_date_local", iso).alias("start_date_local"),
        "timezone",
        F.col("utc_offset_s").alias("utc_offset"),
        "commute", "manual", "private", "flagged", "calories",
        F.array().cast("array<string>").alias("segment_efforts"),
    )
