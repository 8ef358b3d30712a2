from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lakekeel.operators.upsert import latest_per_key, merge_statement, upsert
from lakekeel.sources.files import remove
from lakekeel.sources.tables import LakeTable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(params=["broadcast", "shuffled"])
def either_size(request, spark):
    """Run with a source of broadcastable size and with one that is not."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g" if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def tables(spark, folder):
    """From files, so that the size estimate is the real one."""
    target = spark.createDataFrame([(1, "a", 10, 5), (2, "b", 20, 5), (None, "n", 0, 5)], "k int, v string, born int, seq int")
    source = spark.createDataFrame([(2, "B", 99, 7), (3, "C", 98, 7), (None, "N", 97, 7)], "k int, v string, born int, seq int")
    target.write.parquet(f"{folder}/t")
    source.write.parquet(f"{folder}/s")
    return spark.read.parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/s")


def test_updates_inserts_and_null_keys(spark, folder, either_size):
    target, source = tables(spark, folder)
    merged = upsert(target, source, ["k"])
    assert rows(merged.select("k", "v")) == rows(
        spark.createDataFrame([(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")], "k int, v string")
    )
    assert ("FullOuter" in merged._jdf.queryExecution().executedPlan().toString()) == (either_size == "shuffled")


def test_set_once_columns_stay(spark, folder, either_size):
    target, source = tables(spark, folder)
    born = {r.k: r.born for r in upsert(target, source, ["k"], insert_only=["born"]).filter("k IS NOT NULL").collect()}
    assert born == {1: 10, 2: 20, 3: 98}


def test_older_source_changes_nothing(spark, folder, either_size):
    target, source = tables(spark, folder)
    old = source.withColumn("seq", F.lit(1))
    values = {r.k: r.v for r in upsert(target, old, ["k"], order_by=["seq"]).filter("k IS NOT NULL").collect()}
    assert values == {1: "a", 2: "b", 3: "C"}


def test_latest_per_key_wins_whatever_the_order(spark):
    log = [(1, 5, "click"), (1, 9, "view"), (2, 1, "x"), (None, 1, "n"), (None, 2, "m")]
    for _ in range(3):
        random.shuffle(log)
        newest = latest_per_key(spark.createDataFrame(log, "k int, seq int, v string").repartition(3), ["k"], ["seq"])
        assert rows(newest.select("k", "v")) == [(1, "view"), (2, "x"), (None, "m")]


def test_merge_statement_parses(spark):
    sql = merge_statement("lake.t", "s", ["o", "d"], ["o", "d", "v", "born"], insert_only=["born"])
    logical = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    assert "MergeIntoTable" in logical
    assert "t.`born`" not in sql.split("WHEN NOT MATCHED")[0]


def test_merge_statement_honours_the_order(spark):
    sql = merge_statement("lake.t", "s", ["k"], ["k", "v", "a", "b"], order_by=["a", "b"])
    assert "MergeIntoTable" in spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    assert "WHEN MATCHED AND struct(s.`a`, s.`b`) >= struct(t.`a`, t.`b`) THEN UPDATE" in sql


def reference_state(log):
    """Brute force: newest row per key, first ``born`` per key, deleted keys gone."""
    state = {}
    for key in {k for k, *_ in log}:
        versions = sorted((r for r in log if r[0] == key), key=lambda r: r[1])
        if not versions[-1][4]:
            state[key] = (versions[-1][2], versions[0][3])
    return state


@pytest.mark.parametrize("seed", range(4))
def test_any_split_replay_and_compaction_give_the_same_table(spark, folder, seed):
    rng = random.Random(seed)
    log = [(rng.randrange(12), seq, f"v{seq}", seq * 10, rng.random() < 0.15) for seq in range(1, 60)]
    rng.shuffle(log)
    schema = "k int, _seq bigint, v string, born int, _deleted boolean"
    table = LakeTable(spark, f"{folder}/t{seed}", "k int, v string, born int", ["k"], insert_only=["born"])
    assert not table.exists()
    start = 0
    batch = 0
    while start < len(log):
        size = rng.randrange(5, 30)
        part = spark.createDataFrame(log[start:start + size], schema)
        table.apply(part, f"b{batch}")
        if rng.random() < 0.5:
            table.apply(part, f"b{batch}")
        if rng.random() < 0.5:
            table.compact(share=rng.choice([0, 100]))
        if rng.random() < 0.3:
            table.apply(part, f"b{batch}")
        start, batch = start + size, batch + 1
    assert {r.k: (r.v, r.born) for r in table.snapshot().collect()} == reference_state(log)
    table.compact()
    assert {r.k: (r.v, r.born) for r in table.snapshot().collect()} == reference_state(log)


def test_null_keys_are_inserted_by_every_batch_and_replays_are_not(spark, folder):
    table = LakeTable(spark, f"{folder}/nulls", "k int, v string", ["k"])
    for batch, value in (("a", "x"), ("b", "y"), ("b", "y")):
        table.apply(spark.createDataFrame([(None, value, 1), (1, value, 1)], "k int, v string, _seq int"), batch)
    assert rows(table.snapshot()) == [(1, "y"), (None, "x"), (None, "y")]
    assert not table.compact(after=2)
    table.compact(share=100)
    table.apply(spark.createDataFrame([(None, "z", 1), (1, "z", 2)], "k int, v string, _seq int"), "c")
    table.replace(table.snapshot().filter("false"))
    table.apply(spark.createDataFrame([(None, "x", 1), (1, "x", 1)], "k int, v string, _seq int"), "d")
    table.apply(spark.createDataFrame([(None, "y", 1), (1, "y", 1)], "k int, v string, _seq int"), "e")
    table.compact(share=100)
    table.compact(share=0)
    table.compact(share=0)
    assert rows(table.snapshot()) == [(1, "y"), (None, "x"), (None, "y")]


def test_replace_supersedes_changes(spark, folder):
    table = LakeTable(spark, f"{folder}/r", "k int, v string", ["k"])
    table.apply(spark.createDataFrame([(1, "old", 3)], "k int, v string, _seq int"), "a")
    table.replace(spark.createDataFrame([(2, "new")], "k int, v string"))
    assert rows(table.snapshot()) == [(2, "new")]


def test_a_batch_that_crashed_is_written_again(spark, folder):
    table = LakeTable(spark, f"{folder}/c", "k int, v string", ["k"])
    df = spark.createDataFrame([(1, "a", 1)], "k int, v string, _seq int")
    table.apply(df, "a")
    remove(spark, f"{folder}/c/change-0000000001-a/_SUCCESS")
    assert not table.exists()
    table.apply(spark.createDataFrame([(2, "b", 1)], "k int, v string, _seq int"), "b")
    table.compact()
    table.apply(df, "a")
    assert rows(table.snapshot()) == [(1, "a"), (2, "b")]


def test_little_change_does_not_rewrite_the_base(spark, folder):
    table = LakeTable(spark, f"{folder}/m", "k int, v string", ["k"])
    table.replace(spark.range(50_000).selectExpr("cast(id AS int) AS k", "cast(id * 7919 AS string) AS v"))
    for batch in range(4):
        table.apply(spark.createDataFrame([(batch, "x", batch)], "k int, v string, _seq int"), f"b{batch}")
    assert table.compact(after=3)
    base, changes = table._committed()
    assert base == "base-0000000001" and changes == ["merge-0000000005"]
    assert table.snapshot().filter("v = 'x'").count() == 4 and table.snapshot().count() == 50_000
