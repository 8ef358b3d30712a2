"""Each operator against brute force on rows with every awkward case, and the edge cases its docstring defines."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakekeel.llm import iblt, language
from lakekeel.llm import toxicity as toxicity_module
from lakekeel.llm.best_fit import pack_pieces, plan
from lakekeel.llm.bwt_dedup import Transform, bwt_dedup, merge
from lakekeel.llm.components import connected_components
from lakekeel.llm.html_text import html_extraction, visible_text
from lakekeel.llm.iblt import iblt_fingerprints
from lakekeel.llm.language import language_id
from lakekeel.llm.ngram_jaccard import ngram_jaccard
from lakekeel.llm.piece_codec import model, piece_decode, piece_encode
from lakekeel.llm.stream_dedup import stream_dedup
from lakekeel.llm.tokens import encode, encode_added, token_pieces
from lakekeel.llm.toxicity import toxicity
from lakekeel.llm.training_order import read_shard, slots, stride, training_order, write_shards

BPE, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
#: Columns whose names operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, vertex long, key string, n long, block long, row string"


def rows_of(texts: list[tuple[int | None, str | None]]) -> list[tuple]:
    return [(i, t, "en" if (i or 0) % 2 else None, None, None, 7, "k", 3, None, "r") for i, t in texts]


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    pick = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [pick.choice(words) for _ in range(120)]
    passage = " ".join(pick.choice(words) for _ in range(60))
    found: list[tuple[int | None, str | None]] = [(0, None), (1, ""), (2, " \n\t"), (3, "One"), (4, "one"), (5, "a b c d"), (6, "é 漢字 🙂.")]
    for i in range(10, 60):
        near = list(base)
        for _ in range(i % 9):
            near[pick.randrange(len(near))] = pick.choice(words)
        found.append((i, " ".join(near)))
    found += [(i, " ".join(pick.choice(words) for _ in range(80)) + f".\n{passage}\nEnd {i}!") for i in range(60, 90)]
    found += [(i, "the very same text of a copy, long enough to hold fifty bytes") for i in range(90, 130)]
    found += [(131, "long " * 30_000), (132, " ".join(words * 40)), (None, passage), (None, None), (95, "the very same text of a copy, long enough to hold fifty bytes"), (20, "other words under a known id")]
    return found


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def grams(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def classes(sets: list[frozenset]) -> list[int]:
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    return [root(x) for x in range(len(sets))]


def test_ngram_jaccard(spark, docs, texts):
    sets = [grams(t) for _, t in texts]
    names = defaultdict(list)
    for (i, _), c in zip(texts, classes(sets), strict=True):
        names[c].append(i)
    least = {c: min((i for i in ids if i is not None), default=None) for c, ids in names.items()}
    expected = sorted(((i, len(s), least[c]) for (i, _), s, c in zip(texts, sets, classes(sets), strict=True)), key=str)
    assert sorted(map(tuple, ngram_jaccard(spark, docs).collect()), key=str) == expected


def test_components(spark):
    pick = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(40)] + [(pick.randrange(200, 400), pick.randrange(200, 400)) for _ in range(90)]
    found = dict(map(tuple, connected_components(spark, spark.createDataFrame(edges, "u long, v long")).collect()))
    parent = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(parent[a], parent[b])
            changed |= parent[a] != low or parent[b] != low
            parent[a] = parent[b] = low
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: c for x, c in parent.items() if x in linked}


def test_packing_is_gapless_and_tight(spark, docs, texts):
    pieces = token_pieces(docs, BPE, 64, 2)
    found = pack_pieces(spark, pieces, 64).toPandas()
    known = Tokenizer.from_file(BPE)
    known.encode_special_tokens = True
    whole = sorted((str(i), known.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in texts)
    assert found.length.sum() == sum(len(w) for _, w in whole) and found.length.between(1, 64).all()
    one = found[found.doc_id == 131].sort_values("piece")
    assert b"".join(one.ids) == np.array(dict(whole)["131"], "<u4").tobytes()
    assert (one.length.iloc[1:] == 64).all() and one.start.tolist() == [0, *one.length.cumsum().iloc[:-1]]
    for _, bin_ in found.sort_values("offset").groupby("sequence_id"):
        assert bin_.offset.tolist() == [0, *bin_.length.cumsum().iloc[:-1]] and bin_.length.sum() <= 64
    assert found.sequence_id.nunique() <= -(-found.length.sum() // 64) + 3


@pytest.mark.parametrize("counts", [{}, {10: 3}, {7: 5, 6: 5}, {5: 1, 4: 9, 1: 30}, {3: 100}, {10: 1, 9: 1, 1: 1}])
def test_plan_places_each_piece_once(counts):
    used = defaultdict(set)
    for length, runs in plan(counts, 10).items():
        runs = sorted(runs)
        for (rank, first, offset), stop in zip(runs, [*(r[0] for r in runs[1:]), counts[length]], strict=True):
            for k in range(stop - rank):
                span = set(range(offset, offset + length))
                assert not span & used[first + k] and max(span) < 10
                used[first + k] |= span
    assert sum(map(len, used.values())) == sum(n * c for n, c in counts.items())


def test_tokens_equal_the_library(texts):
    known = Tokenizer.from_file(BPE)
    known.encode_special_tokens = True
    for t in [*(t or "" for _, t in texts[:70]), "a  b \n c\n\nd\te \x1c f", " x", "<|endoftext|>", "it's we'LL 'd ½ Ⅷ ١٢"]:
        assert np.frombuffer(encode(t, BPE), "<u4").tolist() == known.encode(t, add_special_tokens=False).ids


def test_added_tokens_equal_the_library(spark, texts):
    known, end = Tokenizer.from_file(BPE), "<|endoftext|>"
    awkward = ["a<|endoftext|>b", end, f"{end}{end}", f" x  {end}  y\n{end}\n", f"a {end[:-1]} {end}", f"  {end}", f"{end} "]
    for t in [*(t or "" for _, t in texts[:20]), *awkward]:
        assert np.frombuffer(encode_added(t, BPE), "<u4").tolist() == known.encode(t, add_special_tokens=False).ids
    rows = token_pieces(spark.createDataFrame([*enumerate(awkward)], "doc_id long, text string"), BPE, 64, 2).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == {i: [*known.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(awkward)}


def cut(texts):
    least: dict[bytes, float] = {}
    order = [float("inf") if i is None else i for i, _ in texts]
    raw = [(t or "").encode() for _, t in texts]
    for i, b in zip(order, raw, strict=True):
        for j in range(len(b) - 49):
            least[b[j : j + 50]] = min(i, least.get(b[j : j + 50], float("inf")))
    for (doc, _), i, b in zip(texts, order, raw, strict=True):
        covered = np.zeros(len(b) + 1, bool)
        for j in range(len(b) - 49):
            if least[b[j : j + 50]] < i:
                covered[j : j + 50] = True
        kept = np.frombuffer(b, np.uint8)[~covered[:-1]].tobytes()
        yield doc, len(b), int(covered.sum()), int((covered[:-1] & ~np.r_[False, covered[:-2]]).sum()) if b else 0, kept


def test_bwt_dedup(spark, docs, texts):
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in bwt_dedup(spark, docs, keep=("lang",)).collect()]
    assert sorted(found, key=str) == sorted(cut(texts), key=str)


def test_merged_transforms_order_all_strings():
    pick = np.random.default_rng(2)
    shards = [pick.integers(97, 99, 300).astype(np.uint8) for _ in range(3)]
    places = [np.arange(50, 299) for _ in shards]
    transforms = [Transform(s) for s in shards]
    member, interval = merge(transforms, [t.row[p] for t, p in zip(transforms, places, strict=True)], 50)
    strings = [s[p - 50 : p].tobytes() for s, ps in zip(shards, places, strict=True) for p in ps]
    ordered = [strings[m] for m in member]
    assert ordered == sorted(strings) and interval[-1] == len(set(strings)) - 1


def test_piece_codec(spark, docs, texts):
    known = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for t in ["  a   b", "\n\nx \n y", "x▁y", "<s></s><0x41>", "ﬁ ａ \x00", "    ", "漢字 🙂‍🏽"]:
        ids = known.encode(t, add_eos=True)
        assert model(PIECE).encode(t) == " ".join(map(str, ids)).encode() and model(PIECE).decode(model(PIECE).encode(t)) == known.decode(ids)
    expected = [(i, known.encode(t or "", add_eos=True)) for i, t in texts]
    found = piece_decode(piece_encode(docs, PIECE), PIECE).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids, r.text) for r in found), key=str) == sorted(
        ((i, len(x), " ".join(map(str, x)), known.decode(x)) for i, x in expected), key=str
    )


def test_language_id(spark, none):
    pick = random.Random(3)
    syllables = {"aa": ["ka", "to", "mi"], "bb": ["schr", "ung", "ei"], "cc": ["ção", "lh", "ou"]}
    rows = [(i, " ".join("".join(pick.choices(s, k=3)) for _ in range(30)), lang) for i in range(240) for lang, s in [pick.choice(sorted(syllables.items()))]]
    rows += [(1000, None, "aa"), (1001, "12 !?", "aa"), (1002, "ж", None), (None, "kato miko", "aa")]
    found = {r.doc_id: r for r in language_id(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    held = [i for i, _, _ in rows[:240] if found[i].held_out]
    assert held and sum(found[i].lang_pred == lang for i, _, lang in rows[:240] if found[i].held_out) >= 0.97 * len(held)
    assert found[1000].lang_pred == found[1001].lang_pred == "und" and found[1000].score == 0 and found[None].held_out
    assert found[1002].score == 0 and all(0 <= r.score <= 1 for r in found.values())
    assert language_id(spark, none).collect() == []


def test_language_filter_grows(spark, monkeypatch):
    """Seventy languages; one slice, and slices that pass by three at a time, give right answers."""
    pick = random.Random(8)
    letters = [chr(0x4E00 + i) for i in range(840)]
    rows = [(i, "".join(pick.choices(letters[12 * (i % 70) : 12 * (i % 70) + 12], k=300)), f"l{i % 70:02}") for i in range(1400)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)

    def wrong() -> int:
        found = {r.doc_id: r for r in language_id(spark, documents).collect()}
        assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found.values())
        return sum(found[i].lang_pred != lang for i, _, lang in rows)

    assert wrong() == 0
    monkeypatch.setattr(language, "POSITIONS", 1 << 12)
    monkeypatch.setattr(language, "LARGEST", 1 << 17)
    monkeypatch.setattr(language, "BROADCAST", 3 * 2 * 8 << 17)
    assert language.fit(spark, documents)[1].slices > 3 and wrong() == 0
    assert language.shape(5_000_000, 64) == (611, 1 << 17, 2)


@pytest.mark.parametrize("weak", [False, True])
def test_stream_dedup_checks_the_bytes(spark, docs, texts, weak):
    by = defaultdict(list)
    for i, t in texts:
        by[t or ""].append(i)
    digest = (lambda c: F.slice(F.array(F.unhex(F.substring(F.sha2(c, 256), 1, 1))), 1, 1)[0]) if weak else None
    found = stream_dedup(spark, docs, **({"digest": digest} if digest else {})).collect()
    largest = {t: max((i for i in ids if i is not None), default=None) for t, ids in by.items()}
    expected = sorted(((i, largest[t or ""], len(by[t or ""])) for i, t in texts), key=str)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=str) == expected
    assert sorted((str(r.doc_id) for r in found if r.kept)) == sorted(map(str, largest.values()))


def test_stream_dedup_continues(spark, tmp_path):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(3, "a"), (4, "c")], "doc_id long, text string")
    stream_dedup(spark, first, folder=f"file://{tmp_path}").collect()
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in stream_dedup(spark, second, folder=f"file://{tmp_path}").collect()}
    assert found == {1: (3, 2, False), 3: (3, 2, True), 2: (2, 1, True), 4: (4, 1, True)}


def test_stream_dedup_continues_by_bytes(spark, tmp_path):
    """A digest that clashes with one of an earlier call."""
    for rows in ([(1, "a"), (2, "b"), (3, None)], [(4, "a"), (5, "c"), (6, "c")]):
        known = spark.createDataFrame(rows, "doc_id long, text string")
        found = stream_dedup(spark, known, digest=lambda c: F.substring(F.unhex(F.md5(c)), 1, 0), folder=f"file://{tmp_path}").collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in found} == {
        1: (4, 2, False), 2: (2, 1, True), 3: (3, 1, True), 4: (4, 2, True), 5: (6, 2, False), 6: (6, 2, True),
    }


def test_fingerprints(spark, texts, docs):
    rows = sorted({i: t or "" for i, t in texts if i is not None}.items(), reverse=True)
    known = spark.createDataFrame(rows, "doc_id long, text string")
    parts = lambda t: {p for p in re.split(r"\n+|(?<=[.!?])\s+", t) if p.strip(" ")}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    found = {r.doc_id: r for r in iblt_fingerprints(spark, known).collect()}
    assert len(found) == len(rows)
    for k, (i, t) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and found[i].n_chars == len(t)
        assert found[i].near_edited == pytest.approx(like(parts(t), parts(edited))) and found[i].near_next == pytest.approx(like(parts(t), parts(after)))
    assert found[100].fingerprint == found[101].fingerprint != found[131].fingerprint and found[1].fingerprint == ""
    assert iblt_fingerprints(spark, docs).count() == len(texts)


def test_fingerprints_retry_larger(spark, monkeypatch):
    monkeypatch.setattr(iblt, "CELLS_A_DIGEST", 0.1)
    known = spark.createDataFrame([(i, "\n".join(f"line {j * (i + 1)}" for j in range(60))) for i in range(4)], "doc_id long, text string")
    found = {r.doc_id: r.near_next for r in iblt_fingerprints(spark, known).collect()}
    lines = [{f"line {j * (i + 1)}" for j in range(60)} for i in range(4)]
    assert found == {i: pytest.approx(len(lines[i] & lines[(i - 1) % 4]) / len(lines[i] | lines[(i - 1) % 4])) for i in range(4)}


def test_toxicity(spark, none):
    pick = random.Random(4)
    words = [f"plain{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(1500):
        bad = i % 8 == 0
        text = [pick.choice(words) for _ in range(40)] + ([pick.choice(["vile", "grossling"]), f"nasty{pick.choice('abcdef')}"] if bad else [])
        pick.shuffle(text)
        rows.append((i, " ".join(text)))
        marks.append((i, int(bad)))
    rows += [(9000, None), (9001, ""), (None, "vile nastya"), (3, rows[3][1])]
    documents, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*marks, (None, 1), (77_777, None)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity(spark, documents, labels).collect()}
    held = [i for i, _ in marks if found[i].held_out]
    assert held and sum(found[i].predicted == t for i, t in marks if found[i].held_out) >= 0.98 * len(held)
    assert found[9000].score == found[9001].score < 0.5 < found[None].score
    unlabelled = toxicity(spark, documents, labels.limit(0)).collect()
    assert len(unlabelled) == len(rows) and not any(r.predicted for r in unlabelled) and toxicity(spark, none, labels).collect() == []


@pytest.mark.parametrize("local", [toxicity_module.LOCAL, 0])
def test_toxicity_keeps_every_voter(spark, monkeypatch, local):
    monkeypatch.setattr(toxicity_module, "LOCAL", local)
    if not local:
        monkeypatch.setattr(toxicity_module, "ROUNDS", 3)
        monkeypatch.setattr(toxicity_module, "STEPS", 12)
    pick = random.Random(6)
    slurs = ["".join(pick.choices("bcdfghjklm", k=8)) for _ in range(120)]
    rows = [(i, f"plain{i % 7} words{i % 5}" + (f" {slurs[i % 120]}" if i % 10 == 0 else "")) for i in range(12_000)]
    rows = [(i, t.replace(slurs[i % 120], slurs[i // 10 % 120])) for i, t in rows]
    marks = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    voters, weights = toxicity_module.fit(spark, documents, marks)
    assert len(voters) == len(weights) - 1 and {f"={s}" for s in slurs} <= set(voters)
    found = toxicity_module.score(documents, voters, weights).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 10 == 0) for r in found)


@pytest.mark.parametrize("count", [0, 1, 2, 3, 5, 64, 1000])
def test_slots_are_a_permutation(count):
    assert sorted(slots(np.arange(count), count, 9).tolist()) == [*range(count)]
    assert count < 64 or slots(np.arange(count), count, 9).tolist() != slots(np.arange(count), count, 10).tolist()


def test_training_order_round_trip(spark, docs, texts, tmp_path):
    rows = training_order(spark, docs, BPE, 11, 2, tokens=32, shard_records=500)
    table = rows.toPandas()
    assert table.slot.tolist() == [*range(len(table))] and (table.record.str.len() == stride(32) - 1).all()
    write_shards(rows, f"file://{tmp_path}/shards")
    read = [r for s in range(int(table.shard.max()) + 1) for r in read_shard(spark, f"file://{tmp_path}/shards", s, tokens=32)]
    assert [(a, b) for a, b, _ in read] == [(-1 if np.isnan(d) else d, p) for d, p in zip(table.doc_id, table.piece, strict=True)]
    long = b"".join(ids.tobytes() for _, _, ids in sorted((p, 0, ids) for d, p, ids in read if d == 132))
    known = Tokenizer.from_file(BPE).encode(dict(texts)[132], add_special_tokens=False).ids
    assert long == np.array([*known, 2], "<u2").tobytes()
    assert len(list(read_shard(spark, f"file://{tmp_path}/shards", 1, 490, 32))) == min(10, (table.shard == 1).sum() - 490)


PAGES = {
    "<p>a<p>b <b>c</b>": "a\n\nb c",
    "<ul><li>x<li>y<ol><li>1<li>2</ol></ul>z": "- x\n- y\n  1. 1\n  2. 2\n\nz",
    "<table><tr><td>aa<td>b<tr><th>c<th>ddd</table>": "aa  b\nc   ddd",
    "<table><caption>T</caption><tbody><tr><td colspan=2>w<td>x<tr><td>1<td>22<td>3": "T\nw      x\n1  22  3",
    "<head><title>t</title><style>p{}</style></head><body>v<script>'</p>'</script>w": "vw",
    "a<div hidden>b</div><div style='DISPLAY : none'>c</div><template>d</template>e<!-- f -->": "ae",
    "<pre> x\n  y</pre>": " x\n  y", "u&amp;v &lt;w&gt;<br>x": "u&v <w>\nx", "a <span> b </span> c": "a b c",
    "x </b></div> y < z": "x y < z", "": "", "<a href=\"x": "<a href=\"x", "<div>a</div><div>b</div>": "a\nb",
    "<dl><dt>t<dd>d</dl>": "t\n  d", "<select><option>a<option>b</select>": "a\nb", "<p>a<div>b</div>c": "a\n\nb\nc",
}


@pytest.mark.parametrize("page", PAGES)
def test_visible_text(page):
    assert visible_text(page) == PAGES[page]


WHOLE = {
    "x <math><mi>a</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><annotation>tex</annotation></math>": "x a= 1 2",
    "<svg><title>t</title><desc/><defs><text>d</text></defs><path d='M0'/><text>North</text><text>South</text></svg>": "North South",
    "<svg><text>a<div>b</div>c": "a\nb\nc", "<svg><text display='none'>a</text><text>b</text></svg>": "b", "<svg/>a<b/>c": "ac",
    "<math><mtext><b>if</b></mtext><mphantom>n</mphantom><mn>3</mn></math>": "if3",
    "<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td>f": "a  b  c\n   d  e\nf",
    "<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d<td>e": "a  b\n   c\nd  e",
    "<table><tr><td colspan=120>a<td>b<tr><td>c<td>d": "a".ljust(1 + 1 + 2 * 120) + "b\nc  d",
    "<table><tr><td colspan=" + "9" * 5000 + ">a": "a",
}


@pytest.mark.parametrize("page", WHOLE)
def test_visible_text_is_whole(page):
    assert visible_text(page) == WHOLE[page]


@pytest.mark.parametrize("tag", ["font", "b", "div", "span"])
def test_visible_text_below_many_open_elements(tag):
    page = f"<{tag}>" * 60_000 + "<table><tr><td>a<td>b</table><p hidden>no</p><p style='display:none'>no</p><ul><li>c<li>d</ul>"
    assert visible_text(page) == "a  b\n\n- c\n- d"
    tables = visible_text("<table><tr><td>x<td>" * 2000 + "y<td>z")
    assert tables.count("x") == 2000 and re.search(r"y +z", tables)


def test_html_extraction(spark):
    deep = "<div>" * 5000 + "deep"
    rows = [(1, "u", None), (2, "u", ""), (None, None, "<p>x"), (3, "u", deep), (3, "u", "<b>" + "y " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    found = html_extraction(pages, keep=("url", "text")).toDF("page_id", "out", "n", "url", "clash").collect()
    assert sorted(((r.page_id, r.out[:5], r.n) for r in found), key=str) == sorted([(1, "", 0), (2, "", 0), (None, "x", 1), (3, "deep", 4), (3, "y y y", 99_999)], key=str)
    assert html_extraction(pages.limit(0)).collect() == []


def test_empty_tables(spark, none):
    assert ngram_jaccard(spark, none).collect() == bwt_dedup(spark, none).collect() == stream_dedup(spark, none).collect() == []
    assert pack_pieces(spark, token_pieces(none, BPE, 64, 2), 64).collect() == training_order(spark, none, BPE, 1).collect() == []
    assert piece_encode(none, PIECE).collect() == iblt_fingerprints(spark, none).collect() == []
