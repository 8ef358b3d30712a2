"""The pipeline's stages on rows with awkward cases, and its operators as registered queries."""

from __future__ import annotations

import random

import corpus_pipeline
from lakekeel.llm.queries import llm_oracles, llm_queries


def test_stages_in_order(spark, tmp_path):
    pick = random.Random(8)
    words = [f"word{i}" for i in range(300)]
    text = lambda n: " ".join(pick.choice(words) for _ in range(n))
    rows = [(i, text(60), "en", "s", 1) for i in range(400)]
    rows = [(i, f"{t} vile" if i % 7 == 0 else t, *rest) for i, t, *rest in rows]
    base, passage = text(100), text(70)
    rows += [(1000, base, "en", "s", 1), (1001, base, "en", "s", 1), (1002, base + " tail", None, None, None), (1003, f"{text(80)} {passage}", "en", "s", 1)]
    rows += [(1004, f"{passage} {text(80)}", "en", "s", 1), (1005, None, None, None, None), (1006, "", None, None, None), (None, "no id but words here to keep", None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(400)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()}
        if name != "best_fit_packing":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    toxic = {i for i in range(0, 400, 7)}
    assert set(seen["toxicity"]) == {r[0] for r in rows} - toxic
    assert set(seen["toxicity"]) - set(seen["exact_dedup"]) == {1000, 1005}
    assert set(seen["exact_dedup"]) - set(seen["ngram_jaccard"]) == {1002}
    assert set(seen["suffix_array_dedup"]) == set(seen["ngram_jaccard"])
    assert passage in seen["suffix_array_dedup"][1003].text and passage not in seen["suffix_array_dedup"][1004].text
    assert seen["suffix_array_dedup"][1004].n_chars == len(seen["suffix_array_dedup"][1004].text)
    assert set(seen["best_fit_packing"]) == set(seen["suffix_array_dedup"])


def test_registered():
    assert {int(name[2:].split("_")[0]) for name in llm_queries()} == {*range(1, 14)} and set(llm_oracles()) <= set(llm_queries())


def stages(spark, folder, docs):
    """The rows that each stage keeps, as ids."""
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = sorted((r.doc_id for r in docs.collect()), key=str)
    return kept


def test_stages_without_rows(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert set(map(tuple, stages(spark, str(tmp_path), none).values())) == {()}


def test_stages_with_awkward_rows(spark, tmp_path):
    """Other columns of every name the stages use inside, repeated ids and rows, texts of a megabyte."""
    pick = random.Random(4)
    long = " ".join(f"w{pick.randrange(10**6)}" for _ in range(150_000))
    rows = [(1, long), (1, "another text under a known id, and its own words"), (2, long), (3, "short"), (3, "short"), (None, None), (None, None), (4, "")]
    names = ("_id", "_digest", "_key", "score", "digest", "block", "rank", "before", "nth", "piece", "length", "vertex", "n", "own")
    docs = spark.createDataFrame([(i, t, None, None, 0, *["x"] * len(names)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in names))
    kept = stages(spark, str(tmp_path), docs)
    assert kept["toxicity"] == sorted((i for i, _ in rows), key=str)
    assert kept["exact_dedup"] == kept["ngram_jaccard"] == kept["suffix_array_dedup"] == [1, 2, 3, 4]
    assert sorted(set(kept["best_fit_packing"])) == [1, 2, 3, 4]
