from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakekeel.operators.joins import broadcast_limit, estimated_bytes, fits_broadcast, lookup_join, measured_bytes, orphans


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the facts on one key, a fifth without a key, some keys unknown to the dimension."""
    random.seed(5)
    rows = []
    for i in range(3000):
        draw = random.random()
        key = "hot" if draw < 0.33 else "lost" if draw < 0.45 else None if draw < 0.65 else f"k{random.randrange(200)}"
        rows.append((i, key))
    facts = spark.createDataFrame(rows, "n int, k string").repartition(6)
    dimension = spark.createDataFrame([(f"k{i}", i) for i in range(0, 200, 2)] + [("hot", -1)], "k string, v int")
    return rows, facts, dimension


def expected(rows):
    values = {f"k{i}": i for i in range(0, 200, 2)} | {"hot": -1}
    return Counter((k, n, values.get(k)) for n, k in rows)


def test_small_dimension_is_broadcast(spark, skewed, folder):
    rows, facts, dimension = skewed
    dimension.write.parquet(folder)
    stored = spark.read.parquet(folder)
    joined = lookup_join(facts, stored, ["k"])
    assert fits_broadcast(stored) and "BroadcastHashJoin" in plan(joined)
    assert Counter(map(tuple, joined.select("k", "n", "v").collect())) == expected(rows)


def test_large_dimension_keeps_every_row(spark, skewed, no_broadcast):
    rows, facts, dimension = skewed
    assert not fits_broadcast(dimension)
    joined = lookup_join(facts, dimension, ["k"])
    assert Counter(map(tuple, joined.select("k", "n", "v").collect())) == expected(rows)
    assert "CartesianProduct" not in plan(joined) and "NestedLoop" not in plan(joined)


def test_rows_that_compress_well_are_not_broadcast(spark, folder):
    """Stored in a few kilobytes, far larger in memory: the measured size counts."""
    spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("x"), 1000).alias("v")).write.parquet(folder)
    stored = spark.read.parquet(folder)
    assert estimated_bytes(stored) < broadcast_limit(stored) < measured_bytes(stored)
    joined = lookup_join(spark.range(5).select(F.col("id").cast("string").alias("k")), stored, ["k"])
    assert "Broadcast" not in plan(joined)
    assert [len(r.v) for r in joined.collect()] == [1000] * 5


def test_hot_keys_are_split_at_run_time(spark, skewed, no_broadcast):
    """A third of the rows on one key, facts read once."""
    rows, facts, dimension = skewed
    wide = facts.withColumn("pad", F.repeat(F.sha2(F.col("n").cast("string"), 256), 4))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = lookup_join(wide, dimension, ["k"])
        assert Counter((r.k, r.n, r.v) for r in joined.collect()) == expected(rows)
        final = plan(joined).split("== Initial Plan ==")[0]
        assert "skew=true" in final
        assert final.count("Exchange hashpartitioning") == 2
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_two_column_lookup(spark, no_broadcast):
    facts = spark.createDataFrame([("a", "x", i) for i in range(50)] + [("b", None, 1)], "o string, d string, n int")
    dimension = spark.createDataFrame([("a", "x", 7), ("a", "y", 8)], "o string, d string, v int")
    joined = lookup_join(facts, dimension, ["o", "d"]).collect()
    assert len(joined) == 51 and {r.v for r in joined} == {7, None}


def test_orphans_count_rows_once_per_value(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (9,)], "e int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert {tuple(r) for r in orphans(child, "e", parent, "id").collect()} == {(2, 2), (9, 1)}
