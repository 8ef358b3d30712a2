"""Phrases, URL rules and term counts against brute force, with every awkward case of their docstrings."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakekeel.llm import phrase_automata, term_counts
from lakekeel.llm.byte_runs import runs, slices
from lakekeel.llm.phrase_automata import Transducer, phrase_collocations, union
from lakekeel.llm.queries import URL_RULES
from lakekeel.llm.term_counts import radix_order, source_divergence
from lakekeel.llm.url_trie import url_filter

#: Columns whose names operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n long, part string, grp long, number long, key string, a long, size long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 1, "p", 2, 3, "k", 4, 5) for i, t, lang, source in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    pick = random.Random(9)
    words = [f"w{i}" for i in range(30)] + ["Été", "漢字", "a-b", "averyveryverylongword", "anotherverylongwordindeed", "sixteenlettersxy", "x\x00y"]
    weight = [1 / (i + 1) for i in range(len(words))]
    made = []
    for i in range(220):
        lang, source = pick.choice([("en", "s0"), ("en", "s0"), ("en", "s1"), ("en", None), ("de", "s0"), (None, "s2"), ("und", "s1")])
        pieces = [" ".join(pick.choices(words, weight, k=pick.randrange(1, 12))) + pick.choice([". ", ", ", "\n", "; the w0 w1 w2 of\t", "!"]) for _ in range(6)]
        made.append((i, "".join(pieces), lang, source))
    made += [(i, "a hot pair of w0 w1", "en", "s0") for i in range(300, 400)]
    made += [(500, None, "en", "s9"), (501, "", "xx", "s9"), (None, None, None, None), (502, "W0 w1 W2. " * 400, "en", "s1"), (502, "again " * 30, "de", "s0")]
    made += [(503, "one two", "solo", "only"), (504, " .,; 12 ", "none", "s1"), (505, "", "none", "s2"), (507, "anotherverylongwordindeed " * 9, "en", "s1")]
    return made


def collocations(rows, least: int, shown: int) -> set[tuple]:
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 80 * f[p[i : i + k]]}
        kept = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:shown], 1):  # noqa: E741
            found.add((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return found


@pytest.mark.parametrize(("shown", "shard", "ranged", "bits"), [(2000, 1 << 22, 1 << 22, 1 << 30), (7, 900, 700, 1 << 17)])
def test_phrase_collocations(spark, rows, monkeypatch, shown, shard, ranged, bits):
    """Also with many shards and ranges, and a filter so full that it lets all pairs through."""
    if bits < 1 << 20:
        monkeypatch.setattr(phrase_automata, "SEGMENT", 64)
        bits = 64
    found = phrase_collocations(spark, frame(spark, rows), least=4, shown=shown, shard_bytes=shard, range_bytes=ranged, filter_bits=bits)
    expected = collocations(rows, 4, shown)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert len(expected) > 20 and sorted(map(tuple, found.collect())) == sorted(expected)


def test_phrases_of_nothing(spark, rows):
    assert phrase_collocations(spark, frame(spark, rows).limit(0)).collect() == []
    assert phrase_collocations(spark, frame(spark, [(1, None, None, None), (2, "a b c", "en", "s")])).collect() == []


def test_hot_pair_is_spread(spark):
    """A third of all words under one pair: its windows lie in several ranges and its counts are whole."""
    pick = random.Random(2)
    rows = [(i, " ".join(["hot pair", pick.choice("abcdefgh"), pick.choice("ijklmnop"), "tail"]), "en", "s") for i in range(900)]
    found = phrase_collocations(spark, frame(spark, rows), least=3, shard_bytes=2000, range_bytes=500)
    assert sorted(map(tuple, found.collect())) == sorted(collocations(rows, 3, 2000))


def test_transducers():
    pick = np.random.default_rng(4)
    shards = []
    for _ in range(3):
        windows, weights = np.unique(pick.integers(0, 4, (150, 4)).astype(np.uint64), axis=0, return_counts=True)
        shards.append((windows, weights.astype(np.int64)))
    made = [Transducer.from_bytes(Transducer.from_sorted(*s).to_bytes()) for s in shards]
    assert sum(len(x) for x in made[0].label) < sum(len(np.unique(shards[0][0][:, : d + 1], axis=0)) for d in range(4))  # equal states are one
    truth = Counter()
    for windows, weights in shards:
        for w, n in zip(windows.tolist(), weights.tolist(), strict=True):
            for d in range(1, 5):
                if 0 not in w[1 : d - 1]:
                    truth[tuple(w[:d])] += n
    assert {tuple(p): n for prefix, total in union(made, 0) for p, n in zip(prefix.tolist(), total.tolist(), strict=True)} == truth
    both = {tuple(w) for w in shards[0][0].tolist()} & {tuple(w) for w in shards[1][0].tolist()}
    path, weight = made[0].compose(made[1])
    known = {tuple(w): n for w, n in zip(shards[0][0].tolist(), shards[0][1].tolist(), strict=True)}
    assert {tuple(shards[1][0][p].tolist()): n for p, n in zip(path, weight.tolist(), strict=True)} == {w: known[w] for w in both}


@pytest.mark.parametrize("limit", [3, 10, 1000])
def test_slices_and_runs(limit):
    texts = pa.array([b"", b"ab cd", b"x", b"", b"long words in here", b"nocutatallinthisone", b" "], pa.binary())
    blank = np.zeros(256, bool)
    blank[32] = True
    found = defaultdict(list)
    for own in slices(texts.slice(1), blank, limit):
        for a, b in zip(*runs(~blank[own.text], own.offsets), strict=True):
            row = own.first + int(np.searchsorted(own.offsets, a, "right")) - 1
            found[row].append(own.text[a:b].tobytes())
    assert {k: v for k, v in found.items()} == {i: t.split() for i, t in enumerate(texts.slice(1).to_pylist()) if t.split()}


def test_radix_order():
    pick = np.random.default_rng(1)
    keys = [pick.integers(0, 1 << 63, 500, np.uint64) >> np.uint64(40), pick.integers(0, 3, 500).astype(np.uint32)]
    assert radix_order(keys).tolist() == np.lexsort(keys[::-1]).tolist()
    assert radix_order([np.empty(0, np.uint64)]).tolist() == []


def divergence(rows, shown: int) -> set[tuple]:
    docs = [((t or ""), lang or "", source or "") for _, t, lang, source in rows]
    counts, having, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        terms = [t.translate(LOWER) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)]
        langs[lang].add(source)
        counts[lang, source].update(terms)
        having[lang].update(set(terms))
    found = set()
    for lang, sources in langs.items():
        kept = sorted(t for t, n in having[lang].items() if n >= 3)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def share(c: Counter) -> dict:
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (n + len(kept)) for t in kept}

        of, q = {s: share(counts[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pairs = [(-sum((of[s][t] - of[o][t]) ** 2 // of[o][t] for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-((of[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[lang, s][t] and of[s][t] > q[t]]
            for part, listed in (("pair", sorted(pairs)), ("term", sorted(terms)[:shown])):
                found |= {(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(listed, 1)}
    return found


@pytest.mark.parametrize("small", [False, True])
def test_source_divergence(spark, rows, monkeypatch, small):
    """Also with terms in many parts and blocks, sources in several tiles, sums sent early, and texts cut into slices."""
    if small:
        for name, value in (("PART_BYTES", 1500), ("ENTRIES", 20), ("BLOCK_TERMS", 3), ("TILE_SOURCES", 2)):
            monkeypatch.setattr(term_counts, name, value)
    found = source_divergence(spark, frame(spark, rows), terms_shown=5)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == sorted(divergence(rows, 5))


def test_divergence_of_nothing(spark, rows):
    assert source_divergence(spark, frame(spark, rows).limit(0)).collect() == []
    found = source_divergence(spark, frame(spark, [(1, None, None, None), (2, "a", None, "s")]))
    assert sorted(map(tuple, found.collect())) == [("", "", "pair", "s", 0, 1), ("", "s", "pair", "", 0, 1)]


def test_long_document_counts_once(spark):
    """A document longer than a slice has each of its terms once as a document."""
    long = "alpha averyverylongtermoverall " * 60_000
    rows = [(1, long, "en", "a"), (2, "alpha beta", "en", "b"), (3, "beta", "en", "b"), (4, "beta averyverylongtermoverall", "en", "a")]
    assert sorted(map(tuple, source_divergence(spark, frame(spark, rows)).collect())) == sorted(divergence(rows, 200))


URLS = [
    "http://a.example.org/es/x", "https://EXAMPLE.org/en/1", "https://example.org/en/12?q=/es/", "http://example.org", "http://example.org/", "http://x.com/fr/1#t",
    "http://com/de/", "http://x.com/fra/", "http://x.com?/fr/", "//example.org/es/", "ftp://example.org/es", None, "", "http://notexample.org/es/", "://org/",
    "http://example.org:80/es/", "http://user@www.Example.ORG/es/#://com/de/", "http://ÉXAMPLE.com/de/é\n?x", "x://y.org/es/://z.com/de/", "http:///fr/", "http://example.org./es/",
]


def judged(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path, host = re.split("[?#]", rest[len(host) :], maxsplit=1)[0], host.translate(LOWER)
    fits = [
        (len(h) + len(p or ""), len(h), v, h + (p or "")) for h, p, v in rules
        if h and v in ("allow", "block") and ("." + host).endswith("." + h.translate(LOWER)) and path.startswith(p or "")
    ]
    best = max(fits, default=(0, 0, default, None))
    return host, path, best[3], best[2]


MORE = [*URL_RULES, ("example.org", "/es/", "allow"), ("x.com", None, "block"), ("x.com", "/f", "allow"), ("", "/", "block"), (None, "/", "block"), ("org", "", "maybe")]


@pytest.mark.parametrize("most", [1000, 0])
@pytest.mark.parametrize("rules", [list(URL_RULES), MORE, []])
def test_url_filter(spark, most, rules):
    urls = [*URLS, "http://www.a.b.c.example.org" + "/es" * 5000, URLS[0]]
    pages = spark.createDataFrame([*enumerate(urls), (None, URLS[0]), (3, URLS[1])], "page_id long, url string").withColumns(
        {"host": F.lit(1), "path": F.lit("clash"), "rule": F.lit(None).cast("string"), "rule_host": F.lit("x")}
    )
    known = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = url_filter(spark, pages, known, most_rules=most)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    expected = [(r.page_id, *judged(r.url, rules)) for r in pages.collect()]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert url_filter(spark, pages.limit(0), known, most_rules=most).collect() == []
