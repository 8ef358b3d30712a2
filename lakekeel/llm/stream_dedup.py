"""Exact de-duplication as a stream with keyed state on disk.

The state never expires. For each digest it holds the stable identifier of the
row that stays, the locator of its content and the number of rows seen. Digests
that were hit are checked on the full bytes, so an accident of the digest
cannot merge two texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakekeel.llm.shared import stored, whole_texts
from lakekeel.session import ROCKSDB, STATE_STORE, workspace

#: Hit digests up to this number are broadcast (at most some 50 MB); beyond it they are joined by a shuffle.
BROADCAST_DIGESTS = 1_000_000
#: Bytes of digest records that one micro-batch takes.
TRIGGER_BYTES = 1 << 30
#: State goes to the checkpoint as changes, and no file takes room before it has content.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def drain(spark: SparkSession, folder: str) -> DataFrame:
    """Bring the state in ``folder`` up to its records and return it, one row per digest.

    Records that earlier calls have seen are not read again: the checkpoint
    knows them, and the state of the digests they touched is kept.
    """
    records = spark.readStream.schema("digest binary, doc_id long, locator long").option("maxBytesPerTrigger", TRIGGER_BYTES)
    state = (
        records.parquet(f"{folder}/records")
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "locator")).alias("last"), F.count("*").alias("group_size"))
        .select("digest", F.col("last.doc_id").alias("keep_id"), F.col("last.locator").alias("keep_locator"), "group_size")
    )
    settings = {STATE_STORE: ROCKSDB} | STATE_SETTINGS
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        stream = state.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
        stream.foreachBatch(
            lambda rows, batch: rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{folder}/changes/batch={batch}")
        ).start().awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    changes = spark.read.schema("digest binary, keep_id long, keep_locator long, group_size long, batch long").parquet(f"{folder}/changes")
    # Counts and the largest row only grow, so the newest change of a digest holds the largest of each.
    return changes.groupBy("digest").agg(
        F.max(F.struct("keep_id", "keep_locator")).alias("last"), F.max("group_size").alias("group_size")
    ).select("digest", F.col("last.keep_id").alias("keep_id"), F.col("last.keep_locator").alias("keep_locator"), "group_size")


def stream_dedup(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    digest: Callable[[Column], Column] = sha256, folder: str | None = None,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, digest)`` for every row, dropped ones too.

    Texts are equal when their bytes are; NULL counts as empty. Of equal texts
    the row with the largest doc_id stays; a NULL doc_id is smaller than all
    others, and of rows with the same doc_id and text exactly one stays. An
    empty table gives no rows; other columns are ignored. With ``folder`` the
    state and the texts are kept there, and a later call with new documents
    continues it: its rows are then judged against all documents so far, by
    their bytes.
    """
    continued = folder is not None
    folder = folder or workspace(spark, "dedup")
    texts = whole_texts(docs, id_col, text_col).withColumn("digest", digest(F.col("text")))
    locator = F.xxhash64(F.lit(uuid.uuid4().hex), F.monotonically_increasing_id())  # this call's, and the row in it
    records = texts.select("digest", "doc_id", locator.alias("locator"), *(["text"] if continued else []))
    records.write.mode("append").parquet(f"{folder}/records")
    seen = spark.read.schema("digest binary, doc_id long, locator long").parquet(f"{folder}/records")
    state = stored(spark, drain(spark, folder), "dedup-state")

    if continued:  # bytes of all calls
        texts = spark.read.schema("digest binary, doc_id long, text binary").parquet(f"{folder}/records")
    hits = state.where("group_size > 1").select("digest")
    few = hits.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS
    hit_texts = texts.join(F.broadcast(hits) if few else hits, "digest", "left_semi")
    # Grouped by the bytes themselves: copies meet before the shuffle, and no text stands for another.
    if continued and not hit_texts.where("text IS NULL").isEmpty():
        raise ValueError(f"{folder} has records without texts, whose bytes can't be checked")
    distinct = hit_texts.groupBy("digest", "text").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
    clashes = distinct.groupBy("digest").count().where("count > 1").select("digest")
    rows = seen.join(state, "digest").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("locator") == F.col("keep_locator"))).alias("kept"), "digest",
    )
    if clashes.isEmpty():
        return rows
    clashes = stored(spark, clashes, "dedup-clashes")
    apart = texts.join(clashes, "digest", "left_semi")
    by_text = Window.partitionBy("digest", "text")
    exact = apart.select(
        "doc_id", F.max("doc_id").over(by_text).alias("keep_id"), F.count("*").over(by_text).alias("group_size"),
        (F.row_number().over(by_text.orderBy(F.col("doc_id").desc_nulls_last())) == 1).alias("kept"), "digest",
    )
    return rows.join(clashes, "digest", "left_anti").select(exact.columns).union(exact)
