"""Packing of token pieces into sequences by large-item matching.

A bin holds at most two pieces above a third of its capacity, so those are
matched in pairs; smaller pieces go best-fit into the gaps. The plan is made on
the number of pieces of each length (at most ``capacity`` numbers, however many
pieces there are), and each piece finds its place by its rank among the pieces
of its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakekeel.llm.shared import stored

#: Pieces of one length that are ranked together; more are split over blocks.
RANKED_TOGETHER = 100_000


def plan(counts: dict[int, int], capacity: int) -> dict[int, list[tuple[int, int, int]]]:
    """For each length its runs ``(first rank, first sequence, offset)``; a run's ranks fill one sequence each."""
    left = [0] * (capacity + 1)
    for length, count in counts.items():
        left[length] = count
    ranks = [0] * (capacity + 1)
    runs: dict[int, list[tuple[int, int, int]]] = {length: [] for length in counts}
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    opened = 0

    def put(length: int, first: int, count: int, gap: int) -> None:
        runs[length].append((ranks[length], first, capacity - gap))
        ranks[length] += count
        left[length] -= count
        gaps[gap - length].append((first, count))

    third = capacity // 3
    for large in range(capacity, third, -1):
        while left[large]:
            mate = next((m for m in range(min(large, capacity - large), third, -1) if left[m] > (m == large)), 0)
            count = left[large] // 2 if mate == large else min(left[large], left[mate]) if mate else left[large]
            first, opened = opened, opened + count
            put(large, first, count, capacity)
            if mate:
                gaps[capacity - large].pop()
                put(mate, first, count, capacity - large)
    for small in range(third, 0, -1):
        while left[small]:
            gap = next((g for g in range(small, capacity + 1) if gaps[g]), None)
            if gap is None:
                count = -(-left[small] // (capacity // small))
                gaps[capacity].append((opened, count))
                opened += count
                continue
            first, count = gaps[gap].pop()
            used = min(count, left[small])
            if used < count:
                gaps[gap].append((first + used, count - used))
            put(small, first, used, gap)
    return runs


def pack(spark: SparkSession, pieces: DataFrame, capacity: int) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; gapless from 0 in each sequence, at most ``capacity`` long.

    ``pieces`` needs ``doc_id``, ``piece`` and ``length`` (1 to ``capacity``) and
    must be a stored table; its other columns stay, whatever their names, but
    for earlier ``sequence_id`` and ``offset``, which give way. Equal rows get
    different places. An empty table gives no rows.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    counts = {row.length: row["count"] for row in pieces.groupBy("length").count().collect()}
    blocks = -(-max(counts.values(), default=1) // RANKED_TOGETHER)
    own = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    spread = pieces.select("doc_id", "piece", "length", own.alias("own")).withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)))
    sizes = spread.groupBy("length", "block").count()
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = spread.withColumn("nth", F.row_number().over(Window.partitionBy("length", "block").orderBy("doc_id", "piece")))
    ranked = ranked.join(offsets, ["length", "block"]).withColumn("rank", F.col("before") + F.col("nth") - 1)
    runs = {length: np.array(sorted(found), np.int64).reshape(-1, 3) for length, found in plan(counts, capacity).items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = batch.column("rank").to_numpy(), batch.column("length").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for size in np.unique(length).tolist():
                at = np.flatnonzero(length == size)
                run = runs[size][np.searchsorted(runs[size][:, 0], rank[at], "right") - 1]
                sequence[at], offset[at] = run[:, 1] + rank[at] - run[:, 0], run[:, 2]
            yield pa.RecordBatch.from_arrays([*batch.column("own").flatten(), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{name}` {pieces.schema[name].dataType.simpleString()}" for name in names) + ", sequence_id long, offset long"
    return ranked.select("length", "own", "rank").mapInArrow(place, schema)


def pack_pieces(spark: SparkSession, pieces: DataFrame, capacity: int) -> DataFrame:
    """Store the pieces, so that ranks and places come from the same rows, and pack them."""
    return pack(spark, stored(spark, pieces, "pieces"), capacity)
