"""Token ids in training order, as fixed-stride binary records.

Sequences are numbered once, and a keyed Feistel network permutes the numbers:
it permutes a power of four, and numbers that fall outside are permuted again
until they fall inside (cycle-walking). So each sequence knows its place in the
shuffled order from its number, the key and the count alone; range partitions
then write the places in order. A record's bytes are found by multiplication,
and reading can stop and go on at any place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from lakekeel.llm.payload import mix
from lakekeel.llm.shared import stored
from lakekeel.llm.tokens import token_pieces

#: Tokens of a record and records of a shard.
RECORD_TOKENS, SHARD_RECORDS = 256, 65_536
#: Marks the length of a record whose ids have four bytes instead of two.
WIDE = 1 << 15
ROUNDS = 6
#: What ends a record in a shard file.
MARK = b"\n"
HEADER = np.dtype([("doc_id", "<i8"), ("piece", "<i4"), ("length", "<u2")])


def pad(width: int) -> int:
    """Fills a record behind its tokens; no id of a vocabulary of that width."""
    return (1 << 8 * width) - 1


def id_width(path: str) -> int:
    """Bytes of an id: two where the vocabulary's ids are below the padding, else four."""
    ids = Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()
    return 2 if max(ids, default=0) < pad(2) else 4


def stride(tokens: int = RECORD_TOKENS, width: int = 2) -> int:
    return HEADER.itemsize + width * tokens + len(MARK)


def slots(numbers: np.ndarray, count: int, key: int) -> np.ndarray:
    """The place of each number below ``count`` in the order that ``key`` stands for."""
    half = np.uint64(max(1, (max(count - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key % (1 << 63)) * np.uint64(ROUNDS + 1))
    out = numbers.astype(np.uint64)
    outside = np.arange(len(out))
    while len(outside):
        left, right = out[outside] >> half, out[outside] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[outside] = (left << half) | right
        outside = outside[out[outside] >= np.uint64(count)]
    return out.astype(np.int64)


def narrowed(ids: bytes, width: int) -> bytes:
    """Ids of four bytes as ids of ``width``; one that doesn't fit, or is the padding, is an error."""
    found = np.frombuffer(ids, "<u4")
    if len(found) and int(found.max()) >= pad(width):
        raise ValueError(f"token id {found.max()} does not fit {width} bytes")
    return found.astype(f"<u{width}").tobytes()


def _body(column: pa.BinaryArray) -> tuple[np.ndarray, memoryview]:
    """Where the values of a column without NULLs begin and end, and their bytes, one after the other."""
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(len(column) + 1, np.int64), memoryview(b"")
    ends = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    return ends - ends[0], memoryview(data)[ends[0] : ends[-1]]


def _column(ends: np.ndarray, data: bytes) -> pa.BinaryArray:
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _records(width: int):
    """Number the pieces of a task and pack their ids in ``width`` bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, (ends, ids) = batch.num_rows, _body(batch.column("ids"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows, task, np.int64)), pa.array(np.arange(nth, nth + rows)), *(batch.column(c) for c in ("doc_id", "piece", "length")), _column(ends // 4 * width, narrowed(ids, width))],
                names=["task", "nth", "doc_id", "piece", "length", "ids"],
            )
            nth += rows

    return run


def training_order(
    spark: SparkSession, docs: DataFrame, path: str, key: int, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text",
    tokens: int = RECORD_TOKENS, shard_records: int = SHARD_RECORDS,
) -> DataFrame:
    """``(slot, shard, position, doc_id, piece, length, record)`` of every sequence, range-partitioned and sorted by slot.

    A document's ids are cut into sequences of ``tokens``; ``slot`` numbers all
    sequences gaplessly from 0 in the order of ``key``, ``position`` is the
    place in its shard, ``record`` the fixed-stride bytes: doc_id, piece,
    length (little-endian), ids, padding. Ids have two bytes, or four where
    the vocabulary (or ``end_id``) needs them, which the length's highest bit
    says. NULL and empty texts have the end id alone (without one no
    sequence); a NULL doc_id is -1 in the record. Very long texts are many
    sequences. Repeated rows are sequences of their own.
    """
    width = max(id_width(path), 2 if (end_id or 0) < pad(2) else 4)
    if tokens >= WIDE:
        raise ValueError(f"records hold fewer than {WIDE} tokens")
    pieces = token_pieces(docs, path, tokens, end_id, id_col, text_col)
    rows = stored(spark, pieces.mapInArrow(_records(width), "task long, nth long, doc_id long, piece int, length long, ids binary"), "training-pieces")
    sizes = rows.groupBy("task").agg(F.count("*").alias("n"))  # one row per task
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    count = rows.count()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = slots(batch.column("number").to_numpy(), count, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot), *batch.columns[1:]], names=["slot", *batch.schema.names[1:]])

    numbered = rows.join(F.broadcast(starts), "task").select((F.col("before") + F.col("nth")).alias("number"), "doc_id", "piece", "length", "ids")
    placed = numbered.mapInArrow(place, "slot long, doc_id long, piece int, length long, ids binary")
    shards = -(-count // shard_records) if count else 1
    ordered = placed.withColumn("shard", F.floor(F.col("slot") / shard_records)).repartitionByRange(shards, "shard").sortWithinPartitions("slot")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.full((batch.num_rows, tokens), pad(width), f"<u{width}")
            head = np.empty(batch.num_rows, HEADER)
            ends, ids = _body(batch.column("ids"))
            out[np.arange(tokens) < (np.diff(ends) // width)[:, None]] = np.frombuffer(ids, f"<u{width}")
            head["doc_id"], head["piece"] = batch.column("doc_id").fill_null(-1), batch.column("piece")
            head["length"] = batch.column("length").to_numpy() | (WIDE if width == 4 else 0)
            size = stride(tokens, width) - len(MARK)
            records = np.concatenate([head.view(np.uint8).reshape(-1, HEADER.itemsize), out.view(np.uint8).reshape(-1, width * tokens)], axis=1).tobytes()
            slot = batch.column("slot").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("slot"), pa.array(slot // shard_records), pa.array(slot % shard_records), *(batch.column(c) for c in ("doc_id", "piece", "length")), _column(np.arange(batch.num_rows + 1) * size, records)],
                names=["slot", "shard", "position", "doc_id", "piece", "length", "record"],
            )

    return ordered.mapInArrow(render, "slot long, shard long, position long, doc_id long, piece int, length long, record binary")


def write_shards(records: DataFrame, path: str) -> None:
    """One file per shard, the records in order, each with ``MARK`` behind it; failed tasks leave nothing."""
    raw = records.select("shard", F.col("record").cast("string").alias("value"))
    raw.write.partitionBy("shard").option("lineSep", MARK.decode()).option("compression", "none").text(path)


def read_shard(spark: SparkSession, path: str, shard: int, position: int = 0, tokens: int = RECORD_TOKENS) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(doc_id, piece, ids)`` of a shard's records from ``position`` on."""
    for file in spark.read.format("binaryFile").load(f"{path}/shard={shard}").toLocalIterator():
        width = 4 if len(file.content) and np.frombuffer(file.content, HEADER, 1)[0]["length"] & WIDE else 2
        step = stride(tokens, width)
        for at in range(position * step, len(file.content), step):
            head = np.frombuffer(file.content, HEADER, 1, at)[0]
            length = int(head["length"]) & (WIDE - 1)
            yield int(head["doc_id"]), int(head["piece"]), np.frombuffer(file.content, f"<u{width}", length, at + HEADER.itemsize)
