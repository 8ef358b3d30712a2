"""What earlier versions of the operators got wrong, or left untested."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import struct
import time
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from lakekeel.llm import language, queries
from lakekeel.llm import ngram_jaccard as similarity
from lakekeel.llm.best_fit import pack, pack_pieces
from lakekeel.llm.bwt_dedup import Windows, bwt_dedup
from lakekeel.llm.html_text import visible_text
from lakekeel.llm.iblt import iblt_fingerprints
from lakekeel.llm.ngram_jaccard import ngram_jaccard
from lakekeel.llm.piece_codec import model
from lakekeel.llm.shared import stored
from lakekeel.llm.training_order import HEADER, WIDE, id_width, narrowed, pad, read_shard, stride, training_order, write_shards

BPE, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def hashed(key: int, *more: bytes) -> int:
    out = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
    for part in more:
        out = xxhash.xxh64_intdigest(part, out)
    return out - (1 << 64) if out >> 63 else out


def whole(fingerprint: str) -> set[int]:
    """The digests of a fingerprint, by peeling its cells and nothing else."""
    if not fingerprint:
        return set()
    size, raw = fingerprint.split(":", 1)
    size, raw = int(size), base64.b64decode(raw)
    cells = {place: [n, key, check] for place, n, key, check in struct.iter_unpack(">iiqi", raw)}
    found = set()
    while True:
        pure = next((c for c in cells.values() if c[0] == 1 and c[2] == struct.unpack("<i", struct.pack("<q", hashed(c[1], struct.pack("<q", -1)))[:4])[0]), None)
        if pure is None:
            break
        _, key, check = pure
        found.add(key)
        for t in range(3):
            cell = cells[hashed(key, struct.pack("<i", t)) % size + t * size]
            cell[0], cell[1], cell[2] = cell[0] - 1, cell[1] ^ key, cell[2] ^ check
    assert not any(map(any, cells.values())), "cells are left over"
    return found


def test_likeness_follows_from_the_fingerprints(spark):
    pick = random.Random(3)
    lines = [f"Line {i} of a text" for i in range(90)]
    rows = [(i, "\n".join(pick.sample(lines, pick.randrange(1, 60)))) for i in range(40)] + [(50, None), (51, "one line"), (52, "one line"), (53, "\n".join(lines))]
    found = {r.doc_id: r for r in iblt_fingerprints(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    order = sorted(found, reverse=True)
    for i, following in zip(order, [*order[1:], order[0]], strict=True):
        own, edited, other = whole(found[i].fingerprint), whole(found[i].edited_fingerprint), whole(found[following].fingerprint)
        assert found[i].near_edited == pytest.approx(like(own, edited)) and found[i].near_next == pytest.approx(like(own, other))
        assert len(own) == len(set(dict(rows)[i].split("\n")) if dict(rows)[i] else ())
    assert found[51].fingerprint == found[52].fingerprint and found[50].fingerprint == ""


def test_fingerprints_of_repeated_and_missing_ids(spark):
    """Rows of one id follow each other by their text's hash; rows without one come last."""
    texts = ["a\nb", "c", "", "a\nb", None, "x. y. z."]
    rows = [(7, t) for t in texts] + [(None, "a\nq"), (3, "a\nc"), (None, None), (9, "z" * 50_000 + "\nend")] + [(7, f"many {i}") for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("range", "row", "h", "own", "next", "size", "key")})
    order = [
        (r.doc_id, r.text or "") for r in frame.withColumn("t", F.coalesce("text", F.lit(""))).orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("t").desc()).collect()
    ]
    expected = Counter()
    for (i, t), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        half = len(t) // 2
        expected[i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()] += 1
    found = iblt_fingerprints(spark, frame).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == expected


def test_packing_takes_any_column_names(spark):
    names = ["block", "nth", "before", "rank", "sequence_id", "offset", "count", "own", "a b"]
    rows = [(i % 4 or None, 0, 1 + i % 9, *[f"{n}{i}" for n in names]) for i in range(60)]
    columns = ", ".join(f"`{n}` string" for n in names)
    pieces = stored(spark, spark.createDataFrame(rows, f"doc_id long, piece int, length int, {columns}"), "pieces")
    found = pack(spark, pieces, 10)
    assert found.columns == ["doc_id", "piece", "length", *(n for n in names if n not in ("sequence_id", "offset")), "sequence_id", "offset"]
    table = found.toPandas()
    assert sorted(table["block"]) == sorted(f"block{i}" for i in range(60)) and table["a b"].str.startswith("a b").all()
    for _, one in table.sort_values("offset").groupby("sequence_id"):
        assert one.offset.tolist() == [0, *one.length.cumsum().iloc[:-1]] and one.length.sum() <= 10
    assert pack_pieces(spark, pieces.limit(0), 10).collect() == []


def test_long_runs_of_blanks():
    known = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    pick = random.Random(1)
    texts = ["a" + " " * n + "b" for n in (30, 31, 32, 33, 47, 64, 100, 333, 1000)]
    texts += ["".join(pick.choice(["  ", " " * pick.randrange(90), "word", "é", "\n", "x" * 40]) for _ in range(40)) for _ in range(60)]
    for t in texts:
        assert model(PIECE).encode(t) == " ".join(map(str, known.encode(t, add_eos=True))).encode()
    start = time.perf_counter()
    text = "a" + " " * 400_000 + "b"
    ids = model(PIECE).encode(text)
    assert time.perf_counter() - start < 10 and ids == " ".join(map(str, known.encode(text, add_eos=True))).encode()


def test_ids_have_room(spark, tmp_path):
    assert id_width(BPE) == 2 and narrowed(np.array([1, 65_534], "<u4").tobytes(), 2) == np.array([1, 65_534], "<u2").tobytes()
    for ids in ([65_535], [70_000, 1]):
        with pytest.raises(ValueError, match="does not fit 2 bytes"):
            narrowed(np.array(ids, "<u4").tobytes(), 2)
        assert narrowed(np.array(ids, "<u4").tobytes(), 4) == np.array(ids, "<u4").tobytes()
    docs = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id long, text string")
    rows = training_order(spark, docs, BPE, 5, 70_000, tokens=8, shard_records=4)  # an end id that needs four bytes
    records = rows.collect()
    assert all(len(r.record) == stride(8, 4) - 1 and np.frombuffer(r.record, HEADER, 1)[0]["length"] & WIDE for r in records)
    write_shards(rows, f"file://{tmp_path}/shards")
    read = {d: ids.tolist() for d, _, ids in read_shard(spark, f"file://{tmp_path}/shards", 0, tokens=8)}
    assert read[2] == [70_000] and read[1][-1] == 70_000 and pad(4) not in read[1]


def test_languages_are_counted_in_slices(monkeypatch):
    pick = random.Random(2)
    rows = [("".join(pick.choices("abcdeé 漢", k=pick.randrange(200))).encode(), pick.choice(["a", "b"])) for _ in range(300)]
    batches = [pa.RecordBatch.from_arrays([pa.array([t for t, _ in part], pa.binary()), pa.array([x for _, x in part])], names=["text", "lang"]) for part in (rows[:100], rows[100:], rows[:0])]
    expected = Counter((lang, int(g)) for t, lang in rows for g in language.grams(t.decode()).view(np.int64))
    for size, most in ((1 << 20, 1 << 19), (500, 50), (1, 1)):
        monkeypatch.setattr(language, "COUNT_BYTES", size)
        monkeypatch.setattr(language, "COUNTS", most)
        found = Counter()
        for batch in language._count(iter(batches)):
            for lang, gram, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found[lang, gram] += n
        assert found == expected


def test_language_ties_and_copies(spark):
    rows = [(i, text, lang) for i, (text, lang) in enumerate([("aaa bbb ccc", "x"), ("ddd eee fff", "y")] * 20)]
    rows += [(100, "ggg", "x"), (100, "ggg", "x"), (101, "aaa " * 60_000, "x"), (102, "aaa ddd", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit("z") for c in ("gram", "n", "bit", "rate", "counts", "held_out")})
    found = language.language_id(spark, frame).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and by[101].lang_pred == "x" and len({(r.lang_pred, r.score) for r in found if r.doc_id == 100}) == 1
    assert by[102].lang_pred in ("x", "y")


def test_alike_but_below_the_threshold(spark):
    """A template that many documents share without being similar enough, and groups of near copies beside it."""
    pick = random.Random(5)
    template = [f"t{i}" for i in range(70)]
    rows = [(i, " ".join(template + [f"own{i}x{j}" for j in range(40)])) for i in range(120)]
    base = [f"b{i}" for i in range(200)]
    for i in range(200, 260):
        words = list(base)
        words[pick.randrange(200)] = f"new{i}"
        rows.append((i, " ".join(words)))
    found = {r.doc_id: r.component_id for r in ngram_jaccard(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: i if i < 200 else 200 for i, _ in rows}

def least_reachable(rows: list[tuple[int, str]], percent: int = 75) -> dict[int, int]:
    """Component names by comparing all pairs."""
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for _, t in rows)]
    name = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if name[i] != name[j] and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((name[i], name[j]))
                name = [low if x == high else x for x in name]
    return {rows[i][0]: rows[x][0] for i, x in enumerate(name)}


def outskirts(members: int, outsiders: int) -> list[tuple[int, str]]:
    """A base, documents without one run of its words, and documents without two, which are similar to the base and few others."""
    pick = random.Random(12)
    words = [f"w{i}" for i in range(300)]

    def without(runs, length):
        gone = {at + i for at in (pick.randrange(300 - length) for _ in range(runs)) for i in range(length)}
        return " ".join(w for i, w in enumerate(words) if i not in gone)

    texts = [without(1, 20) for _ in range(members)] + [without(2, 28) for _ in range(outsiders)] + [" ".join(words)]
    return [(i, t) for i, t in enumerate(pick.sample(texts, len(texts)))]


def test_outsiders_are_not_compared_with_all_members(spark, monkeypatch):
    rows, compared, possible = outskirts(300, 100), [], similarity._possible

    def counting(pairs, heads, percent):
        compared.append(pairs.count())
        return possible(pairs, heads, percent)

    monkeypatch.setattr(similarity, "_possible", counting)
    found = {r.doc_id: r.component_id for r in ngram_jaccard(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == least_reachable(rows)
    assert sum(compared) < 6 * len(rows)


def test_copies_in_other_blocks_are_one_vertex(spark, monkeypatch):
    """The same few texts again and again, a block each: no more pairs than for one block."""
    rows, compared, possible = outskirts(20, 0), [], similarity._possible
    rows = [(len(rows) * k + i, t) for k in range(16) for i, t in rows]

    def counting(pairs, heads, percent):
        compared.append(pairs.count())
        return possible(pairs, heads, percent)

    monkeypatch.setattr(similarity, "_possible", counting)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16, "doc_id")
    found = {r.doc_id: r.component_id for r in ngram_jaccard(spark, docs).collect()}
    assert found == least_reachable(rows)
    assert sum(compared) < len(rows)

def test_postings_are_made_in_little_memory(monkeypatch):
    """17 MB of texts, each of other words: what a task holds at a time doesn't follow from them."""
    monkeypatch.setattr(similarity, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))

    def batches():
        for i in range(17):
            yield pa.RecordBatch.from_pydict({"doc_id": [i], "text": [b" ".join(b"%d" % (i * 10**6 + j * 7) for j in range(120_000)).ljust(10**6)]})

    tracemalloc.start()
    try:
        rows = sum(batch.num_rows for batch in similarity._postings(5, 4)(batches()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows % 17 == 0 and peak < 80 << 20


def test_hot_passage(spark):
    """One passage in a third of all rows, and one anchor's windows of many contents."""
    pick = random.Random(6)
    passage = "the passage that a third of all documents hold, with more than fifty bytes of its own"
    rows = [(i, f"{pick.random()} start {passage if i % 3 == 0 else ''} end {pick.random()}") for i in range(300)]
    found = {r.doc_id: r.n_removed for r in bwt_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert found[0] == 0 and all(found[i] >= len(passage) for i in range(3, 300, 3)) and not any(found[i] for i in range(300) if i % 3)


SEEN = {
    "<table><td>a<td>b</table>": "a  b", "<table><tbody><td>a<th>b<tr><td>cc</table>": "a   b\ncc", "x<dialog>no</dialog><dialog open>yes</dialog>": "xyes",
    "<details><summary>s</summary>no<p>no</details><details open><summary>t</summary>yes</details>": "s\nt\nyes",
    "<p style='visibility:hidden'>no <b style='visibility:visible'>yes</b> no</p>": "yes",
    "<div hidden>no <b style='visibility:visible'>no</b></div>z": "z",
    "<table><tr style='visibility:collapse'><td>no<td style='visibility: visible'>b<tr><td>c<td>d</table>": "   b\nc  d",
    "<ol start=5><li>a<li value=9>b<li>c</ol>": "5. a\n9. b\n10. c", "<ol reversed><li>a<li>b</ol>": "2. a\n1. b", "<ol start=x><li value=-2>a<li>b": "-2. a\n-1. b",
    "<style>.x, #y{display:none} p.z{ visibility : hidden }</style><b class='w x'>no</b><i id=y>no</i><u id=x>u</u><p class=z>no<i class=z>no</i></p>": "u",
    "<style>/* .a{display:none} */ @media print{.b{display:none}} .c{display:none} div.c{display:block}</style><i class=a>a</i><i class=b>b</i><i class=c>no</i><div class=c>c</div>": "ab\nc",
    "<style>b{display:none}</style><b style='display:inline'>b</b><b>no</b><style>.q{content:'x'}</style>": "b",
    "<table><tr><td>漢字<td>x<tr><td>abc<td>y</table>": "漢字  x\nabc   y", "<table><tr><td>e\u0301<td>x<tr><td>ab<td>y</table>": "e\u0301   x\nab  y",
}


@pytest.mark.parametrize("page", SEEN)
def test_what_a_reader_sees(page):
    assert visible_text(page) == SEEN[page]


def test_op_queries_have_their_columns(spark):
    """The registered functions themselves, on the smallest tables."""
    sf = "/root/testdata/sf0.001"
    columns = {
        "op1_ngram_jaccard": ["doc_id", "n_shingles", "component_id"],
        "op4_suffix_array_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op5_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op9_document_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    }
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    known = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for name, wanted in columns.items():
        rows = queries.llm_queries()[name](spark, sf)
        assert rows.columns == wanted and sorted(r.doc_id for r in rows.collect()) == sorted(texts)
    for r in queries.op5_sentencepiece(spark, sf).collect():
        ids = known.encode(texts[r.doc_id], add_eos=True)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(known.decode(ids).encode()).hexdigest()
    for r in queries.op1_ngram_jaccard(spark, sf).collect():
        words = re.split("[\x20\x09-\x0d]+", texts[r.doc_id].encode().lower().decode().strip(" \t\n\v\f\r"))
        words = [w for w in words if w]
        assert r.n_shingles == (len({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}) if words else 0)


def test_anchors_fall_evenly_on_parts():
    text = np.random.default_rng(7).integers(97, 123, 400_000).astype(np.uint8)
    keys = np.unique(Windows(text, np.full(400, 1_000)).key)
    sizes = np.bincount((keys >> np.uint64(60)).astype(np.int64), minlength=16)
    assert sizes.min() > 0 and sizes.max() < 1.5 * sizes.mean()


def test_records_are_packed_from_whole_columns():
    """Ids are narrowed a column at a time, also where the column is a slice of a larger one."""
    from lakekeel.llm.training_order import _body, _column

    ids = [np.array(v, "<u4").tobytes() for v in ([1, 2], [], [3, 70, 500], [9])]
    ends, data = _body(pa.array(ids, pa.binary())[1:])
    packed = _column(ends // 4 * 2, narrowed(data, 2))
    assert [np.frombuffer(v, "<u2").tolist() for v in packed.to_pylist()] == [[], [3, 70, 500], [9]]


def test_words_with_white_space_at_an_end_are_not_taken_alone():
    from tokenizers import Tokenizer

    from lakekeel.llm.tokens import _vocabulary, encode_added

    library = Tokenizer.from_file(BPE)
    for text in ("\ta b", "a\t b", "a \tb", "a\r\nb", "a\n", " a ", "a b\tc", "a  b"):
        assert np.frombuffer(encode_added(text, BPE), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    with pytest.raises(KeyError):
        _vocabulary(BPE)[2]["a\t"]
