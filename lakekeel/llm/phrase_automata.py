"""Phrase collocations by weighted acyclic automata.

A shard of documents sorts its windows of words and builds a count transducer
from them: a path is a language and the words of a window, an arc's weight says
how often its prefix occurs, and equal states are one. Transducers are cut into
ranges of the order of windows, and those of one range are united, their
weights summed prefix by prefix; a prefix that is too rare is not followed.
Ranges are cut by the windows themselves, so a prefix of a third of all windows
lies in many of them, and its few partial sums are added at the end.

First come windows of two words, of all text. Longer phrases hold only frequent
pairs, so windows of four words then come from the runs of such pairs, told by
a Bloom filter of bounded size (a fuller one lets more windows through, never
fewer). Last, the parts of all candidates are one more transducer for each
range, and its composition with the range's counts gives every part's weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakekeel.llm.byte_runs import LOWER, SLICE_BYTES, ranges, runs, slices
from lakekeel.llm.payload import mix
from lakekeel.llm.shared import Tables, power_of_two, stored, text_bytes

#: Text bytes of a shard's transducer, and for each range.
SHARD_BYTES, RANGE_BYTES = 4 << 20, 4 << 20
#: Words of a phrase at most, occurrences at least, and phrases shown of a language.
WORDS, LEAST, SHOWN = 4, 30, 2000
#: A phrase goes if a longer one has so many percent of its occurrences.
INSIDE_PERCENT = 80
#: Bits of the filter for each pair, bits at least and at most (128 MB), and of a segment.
ROOM, BITS, LARGEST, SEGMENT = 16, 1 << 20, 1 << 30, 1 << 17
#: Documents from which the ranges are cut (this only balances them), and every how manieth of their windows.
SAMPLE_DOCUMENTS, SAMPLE_EVERY = 4000, 32
#: Behind a window that its piece ends.
END = 0
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

#: Classes of bytes: 0 of a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[32, 9]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 2
_CUT = _KIND == 2


class Transducer:
    """A weighted acyclic automaton of rows of equal width: arcs by level, states of a level by where their arcs begin.

    ``label``, ``weight`` and ``target`` have an array for each level;
    ``begin[d]`` says where the arcs of each state before level d begin.
    """

    def __init__(self, label: list[np.ndarray], weight: list[np.ndarray], target: list[np.ndarray], begin: list[np.ndarray]):
        self.label, self.weight, self.target, self.begin = label, weight, target, begin

    @classmethod
    def from_sorted(cls, windows: np.ndarray, weights: np.ndarray) -> Transducer:
        """From distinct rows in order. Level after level, a new prefix adds an arc; then equal states become one, last level first."""
        n, width = windows.shape
        new = np.zeros(n, bool)
        new[:1] = True
        at, label, weight = [], [], []
        for d in range(width):
            new[1:] |= windows[1:, d] != windows[:-1, d]
            first = np.flatnonzero(new)
            at.append(first)
            label.append(windows[first, d])
            weight.append(np.add.reduceat(weights, first) if n else np.empty(0, np.int64))
        begin = [np.array([0, len(at[0])])]
        target = [np.empty(0, np.int64)] * width
        for d in range(1, width):
            begin.append(np.r_[np.searchsorted(at[d], at[d - 1]), len(at[d])])
            target[d - 1] = np.arange(len(at[d - 1]))
        made = cls(label, weight, target, begin)
        for d in range(width - 1, 0, -1):
            made._share(d)
        return made

    def _share(self, d: int) -> None:
        """States before level d that have the same arcs become one."""
        begin = self.begin[d]
        size = np.diff(begin)
        if len(size) < 2:
            return
        end = self.target[d].astype(np.uint64) if len(self.target[d]) else np.zeros(len(self.label[d]), np.uint64)
        arc = mix(self.label[d] + mix(self.weight[d].astype(np.uint64) + mix(end + np.uint64(d))))
        state = mix(np.add.reduceat(arc, begin[:-1]) + size.astype(np.uint64))
        _, first, same = np.unique(state, return_index=True, return_inverse=True)
        like = first[same]
        like = np.where(size == size[like], like, np.arange(len(size)))
        other = ranges(begin[like], size)
        differ = (self.label[d] != self.label[d][other]) | (self.weight[d] != self.weight[d][other])
        if len(self.target[d]):
            differ |= self.target[d] != self.target[d][other]
        like = np.where(np.logical_or.reduceat(differ, begin[:-1]), np.arange(len(size)), like)
        own = like == np.arange(len(size))
        number = np.cumsum(own) - 1
        arcs = np.repeat(own, size)
        self.label[d], self.weight[d] = self.label[d][arcs], self.weight[d][arcs]
        if len(self.target[d]):
            self.target[d] = self.target[d][arcs]
        self.begin[d] = np.r_[0, np.cumsum(size[own])]
        self.target[d - 1] = number[like][self.target[d - 1]]

    def to_bytes(self) -> bytes:
        names, number = np.unique(np.concatenate(self.label), return_inverse=True)
        columns = {"names": names, "label": number, "cuts": np.cumsum([len(x) for x in self.label])}
        columns |= {f"weight{d}": x for d, x in enumerate(self.weight)} | {f"target{d}": x for d, x in enumerate(self.target)}
        columns |= {f"size{d}": np.diff(x) for d, x in enumerate(self.begin)}
        columns = {k: v if k == "names" else _narrow(v) for k, v in columns.items()}
        kinds = pa.schema([(k, pa.list_(pa.from_numpy_dtype(v.dtype))) for k, v in columns.items()])
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, kinds) as writer:
            writer.write_batch(pa.RecordBatch.from_pydict({k: [v] for k, v in columns.items()}, kinds))
        return out.getvalue().to_pybytes()

    @classmethod
    def from_bytes(cls, payload: bytes) -> Transducer:
        table = pa.ipc.open_stream(payload).read_all()
        own = {c: table.column(c).combine_chunks().flatten().to_numpy() for c in table.column_names}
        width = len(own["cuts"])
        label = np.split(own["names"][own["label"]], own["cuts"][:-1].astype(np.int64))
        wide = lambda name: [own[f"{name}{d}"].astype(np.int64) for d in range(width)]
        return cls(label, wide("weight"), wide("target"), [np.r_[0, np.cumsum(x)] for x in wide("size")])

    def compose(self, asked: Transducer) -> tuple[np.ndarray, np.ndarray]:
        """The rows that both have, as the numbers of the asked one's paths in order, and their weights here."""
        mine, theirs, path = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        paths = asked._paths()
        for d in range(len(self.label)):
            size = np.diff(asked.begin[d])[theirs]
            arc = ranges(asked.begin[d][theirs], size)
            # A path's number: those of all paths before it under the same state.
            path = np.repeat(path, size) + (asked._before(d, paths)[arc])
            label, state = asked.label[d][arc], np.repeat(mine, size)
            key = np.stack([np.repeat(np.arange(len(self.begin[d]) - 1), np.diff(self.begin[d])).astype(np.uint64), self.label[d]], 1)
            want = np.stack([state.astype(np.uint64), label], 1)
            place = _rows(key).searchsorted(_rows(want)) if len(key) else np.zeros(len(want), np.int64)
            place = np.minimum(place, max(len(key) - 1, 0))
            found = (key[place] == want).all(1) if len(key) else np.zeros(len(want), bool)
            path, place, arc = path[found], place[found], arc[found]
            if d + 1 < len(self.label):
                mine, theirs = self.target[d][place], asked.target[d][arc]
            else:
                return path, self.weight[d][place]
        return path, np.empty(0, np.int64)

    def _paths(self) -> list[np.ndarray]:
        """For each level, the number of paths that go on from each arc."""
        width = len(self.label)
        out = [np.empty(0, np.int64)] * width
        out[-1] = np.ones(len(self.label[-1]), np.int64)
        for d in range(width - 2, -1, -1):
            total = np.r_[0, np.cumsum(out[d + 1])]
            out[d] = np.diff(total[self.begin[d + 1]])[self.target[d]]
        return out

    def _before(self, d: int, paths: list[np.ndarray]) -> np.ndarray:
        """For each arc of a level, the number of paths of the arcs before it of the same state."""
        before = np.cumsum(paths[d]) - paths[d]
        size = np.diff(self.begin[d])
        return before - np.repeat(before[self.begin[d][:-1]] if len(before) else before, size)


def _narrow(values: np.ndarray) -> np.ndarray:
    most = int(values.max(initial=0))
    return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if most <= np.iinfo(t).max))


def _rows(windows: np.ndarray) -> np.ndarray:
    """Rows as byte strings of the same order."""
    return np.ascontiguousarray(windows.astype(">u8")).view(f"S{8 * windows.shape[1]}").ravel()


def union(several: list[Transducer], least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Level after level the prefixes and summed weights of some transducers of one range.

    Prefixes of less than ``least`` are not followed, but for those at the
    range's ends: what they lack may lie beside. The first level is whole.
    """
    state = np.concatenate([[0] * bool(len(t.label[0])) for t in several]).astype(np.int64)
    merged, prefix = np.zeros(len(state), np.int64), np.empty((1, 0), np.uint64)
    owner = np.array([i for i, t in enumerate(several) if len(t.label[0])], np.int64)
    for d in range(len(several[0].label)):
        states = np.cumsum([0, *(len(t.begin[d]) - 1 for t in several)])
        arcs = np.cumsum([0, *(len(t.label[d]) for t in several)])
        begin = np.concatenate([t.begin[d][:-1] + a for t, a in zip(several, arcs, strict=False)])
        size = np.concatenate([np.diff(t.begin[d]) for t in several])
        at = states[owner] + state
        arc = ranges(begin[at], size[at])
        merged, owner = np.repeat(merged, size[at]), np.repeat(owner, size[at])
        label, weight = (np.concatenate([x[d] for x in y])[arc] for y in ([t.label for t in several], [t.weight for t in several]))
        target = np.concatenate([t.target[d] for t in several])[arc] if d + 1 < len(several[0].label) else arc
        order = np.lexsort((label, merged))
        merged, owner, label, weight, target = merged[order], owner[order], label[order], weight[order], target[order]
        new = np.r_[True, (merged[1:] != merged[:-1]) | (label[1:] != label[:-1])] if len(label) else np.empty(0, bool)
        first = np.flatnonzero(new)
        total = np.add.reduceat(weight, first) if len(first) else np.empty(0, np.int64)
        kept = total >= (least if d else 0)
        kept[:1] = kept[-1:] = True
        prefix = np.column_stack([prefix[merged[first]], label[first]])[kept]
        yield prefix, total[kept]
        follow = kept & ((label[first] != END) | (d == 0))
        number = np.cumsum(kept) - 1
        group = np.cumsum(new) - 1
        on = follow[group]
        merged, owner, state = number[group[on]], owner[on], target[on]


class _Words:
    """Words of a slice: keys, languages, whether the next word is of the same piece, and their bytes' places."""

    table = mix(np.arange(1, 257, dtype=np.uint64) * _FACTOR)
    ahead = back = np.ones(1, np.uint64)

    @classmethod
    def _powers(cls, n: int) -> None:
        if len(cls.ahead) <= n:
            size = power_of_two(n + 1, SLICE_BYTES)
            cls.ahead, cls.back = (np.r_[np.uint64(1), np.multiply.accumulate(np.full(size, b, np.uint64))] for b in (_FACTOR, np.uint64(pow(int(_FACTOR), -1, 1 << 64))))

    def __init__(self, text: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        self._powers(len(text))
        kind = _KIND[text]
        self.text = LOWER[text]
        self.start, self.end = runs(kind == 0, offsets)
        doc = np.searchsorted(offsets, self.start, "right") - 1
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self.table[self.text] * self.ahead[: len(text)], out=sums[1:])
        self.key = np.maximum(mix((sums[self.end] - sums[self.start]) * self.back[self.start]), np.uint64(1))
        self.lang = langs[doc]
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.start]
        self.linked = np.zeros(len(doc), bool)
        self.linked[:-1] = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])

    def words(self, chosen: np.ndarray) -> list[bytes]:
        raw = self.text.tobytes()
        return [raw[a:b] for a, b in zip(self.start[chosen].tolist(), self.end[chosen].tolist(), strict=True)]


def _pairs(lang: np.ndarray, first: np.ndarray, second: np.ndarray, bits: int) -> list[np.ndarray]:
    """The positions of pairs in a filter of so many bits."""
    hashed = mix(mix(lang + first * _FACTOR) + second)
    return [((hashed >> np.uint64(shift)) & np.uint64(bits - 1)).astype(np.int64) for shift in (0, 34)]


def _distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and how often each occurs. Columns are numbered first, so that few sorts are of wide keys."""
    n = len(columns[0])
    if not n:
        return np.empty((0, len(columns)), np.uint64), np.empty(0, np.int64)
    _, words = np.unique(np.concatenate(columns[1:]), return_inverse=True)
    wide = int(words.max()) + 1
    _, code = np.unique(columns[0], return_inverse=True)
    span = int(code.max()) + 1
    for i in range(len(columns) - 1):
        if span * wide >= 1 << 62:
            _, code = np.unique(code, return_inverse=True)
            span = int(code.max()) + 1
        code = code * wide + words[i * n : (i + 1) * n]
        span *= wide
    _, first, count = np.unique(code, return_index=True, return_counts=True)
    return np.stack([c[first] for c in columns], 1), count.astype(np.int64)


class _Shard:
    """Windows of some documents: of two words, or, with a filter of frequent pairs, of four words in runs of such pairs."""

    def __init__(self, seen: np.ndarray | None):
        self.seen, self.held, self.size, self.words = seen, [], 0, {}

    def add(self, found: _Words) -> None:
        key = found.key
        if not len(key):
            return
        next_ = lambda x, by: np.r_[x[by:], np.zeros(min(by, len(x)), x.dtype)]
        second = np.where(found.linked, next_(key, 1), np.uint64(END))
        if self.seen is None:
            self.held.append([found.lang, key, second])
        else:
            linked = found.linked.copy()
            places = _pairs(found.lang[linked], key[linked], second[linked], 8 * len(self.seen))
            linked[linked] = np.logical_and.reduce([(self.seen[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1 for p in places])
            two = linked & next_(linked, 1)
            three = two & next_(linked, 2)
            at = np.flatnonzero(two)
            self.held.append([found.lang[at], key[at], key[at + 1], key[at + 2], np.where(three[at], next_(key, 3)[at], np.uint64(END))])
            near = np.flatnonzero(linked | np.r_[False, linked[:-1]])
            keys, first = np.unique(key[near], return_index=True)
            fresh = np.array([k not in self.words for k in keys.tolist()], bool)
            self.words |= dict(zip(keys[fresh].tolist(), found.words(near[first[fresh]]), strict=True))
        self.size += len(found.text)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        return _distinct([np.concatenate(x) for x in zip(*self.held, strict=True)])


def _shards(seen, then, limit: int = SHARD_BYTES):
    """Batches ``(lang, text)`` to what ``then`` makes of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = seen.value if seen else None
        shard = _Shard(table)
        for batch in batches:
            langs = batch.column("lang").to_numpy().view(np.uint64)
            for own in slices(batch.column("text"), _CUT):
                shard.add(_Words(own.text, own.offsets, langs[own.first : own.first + len(own.offsets) - 1]))
                if shard.size >= limit:
                    yield from then(shard)
                    shard = _Shard(table)
        if shard.held:
            yield from then(shard)

    return run


_SENT = pa.schema([("part", pa.int64()), ("payload", pa.binary())])


def _sampled(shard: _Shard) -> Iterator[pa.RecordBatch]:
    found = _rows(shard.windows()[0][::SAMPLE_EVERY])
    width = found.dtype.itemsize
    raw = found.tobytes()
    yield pa.RecordBatch.from_arrays([pa.array([raw[i : i + width] for i in range(0, len(raw), width)], pa.binary())], names=["key"])


def _sent(bounds: list[bytes]):
    """A shard's transducer, range by range; the words of its runs go to parts below zero."""

    def run(shard: _Shard) -> Iterator[pa.RecordBatch]:
        windows, weights = shard.windows()
        cuts = [0, *_rows(windows).searchsorted(np.array(bounds, f"S{8 * windows.shape[1]}")).tolist(), len(windows)] if bounds else [0, len(windows)]
        for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                payload = Transducer.from_sorted(windows[a:b], weights[a:b]).to_bytes()
                yield pa.RecordBatch.from_pylist([{"part": part, "payload": payload}], _SENT)
        if shard.words:
            keys = np.array(sorted(shard.words), np.uint64)
            part = (keys >> np.uint64(56)).astype(np.int64) * (len(bounds) + 1) >> 8
            for p in np.unique(part).tolist():
                own = keys[part == p]
                words = pa.RecordBatch.from_arrays([pa.array(own), pa.array([shard.words[k] for k in own.tolist()], pa.binary())], names=["key", "word"])
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, words.schema) as writer:
                    writer.write_batch(words)
                yield pa.RecordBatch.from_pylist([{"part": -1 - p, "payload": out.getvalue().to_pybytes()}], _SENT)

    return run


_COUNTS = "lang long, phrase binary, n long, word binary"


def _phrases(windows: np.ndarray) -> list[bytes]:
    """Word keys of rows as bytes, the language and what comes after the end left out."""
    raw = np.ascontiguousarray(windows[:, 1:].astype(">u8")).tobytes()
    width = 8 * (windows.shape[1] - 1)
    size = 8 * (windows[:, 1:] != END).sum(1)
    return [raw[i * width : i * width + s] for i, s in enumerate(size.tolist())]


def _united(least: int, levels: range):
    """One range's transducers united: its frequent prefixes of some levels with their weights; or distinct words."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() < 0:
            keys, words = zip(*((t.column("key").to_numpy(), t.column("word").combine_chunks()) for t in (pa.ipc.open_stream(p.as_py()).read_all() for p in table.column("payload"))), strict=True)
            found, first = np.unique(np.concatenate(keys), return_index=True)
            word = pa.concat_arrays(words).take(pa.array(first))
            raw = found.astype(">u8").tobytes()
            return pa.table({
                "lang": pa.nulls(len(found), pa.int64()), "phrase": pa.array([raw[i : i + 8] for i in range(0, len(raw), 8)], pa.binary()),
                "n": pa.nulls(len(found), pa.int64()), "word": word,
            })
        lang, phrase, n = [], [], []
        for d, (prefix, total) in enumerate(union([Transducer.from_bytes(p.as_py()) for p in table.column("payload")], least)):
            if d in levels:
                real = (prefix[:, -1] != END) | (d == 0)
                lang.append(prefix[real, 0].astype(np.int64))
                phrase += _phrases(prefix[real])
                n.append(total[real])
        return pa.table({
            "lang": np.concatenate([*lang, np.empty(0, np.int64)]), "phrase": pa.array(phrase, pa.binary()),
            "n": np.concatenate([*n, np.empty(0, np.int64)]), "word": pa.nulls(len(phrase), pa.binary()),
        })

    return run


def _bounds(spark: SparkSession, texts: DataFrame, seen, share: float, parts: int) -> list[bytes]:
    """The first window of each range but the first, from a sample of documents."""
    sample = texts.sample(share, 11) if share < 1 else texts
    keys = sample.mapInArrow(_shards(seen, _sampled), "key binary")
    ranged = keys.repartitionByRange(parts, "key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("key"))
    return [bytes(row.key) for row in ranged.orderBy("key").collect()][1:]


def _filter(spark: SparkSession, pairs: DataFrame, most: int) -> np.ndarray:
    """A Bloom filter of frequent pairs, as bytes; made in segments."""
    bits = min(power_of_two(ROOM * pairs.count(), BITS), most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column("phrase").to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
            at = np.concatenate(_pairs(batch.column("lang").to_numpy().view(np.uint64), raw[:, 0], raw[:, 1], bits))
            yield pa.RecordBatch.from_arrays([pa.array(at // SEGMENT), pa.array(at % SEGMENT)], names=["segment", "at"])

    def segment(table: pa.Table) -> pa.Table:
        held = np.zeros(SEGMENT, np.uint8)
        held[table.column("at").to_numpy()] = 1
        return pa.table({"segment": table.column("segment")[:1], "held": pa.array([np.packbits(held, bitorder="little").tobytes()])})

    made = pairs.select("lang", "phrase").mapInArrow(run, "segment long, at long").distinct().groupBy("segment").applyInArrow(segment, "segment long, held binary")
    table = np.zeros(bits // 8, np.uint8)
    for row in made.toLocalIterator():
        table[row.segment * SEGMENT // 8 : (row.segment + 1) * SEGMENT // 8] = np.frombuffer(row.held, np.uint8)
    return table


def _routed(bounds: list[bytes]):
    """Rows ``(lang, phrase, n)`` with the range of their first words."""
    width = len(bounds[0]) // 8 if bounds else 3
    limits = np.array(bounds, f"S{8 * width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _windows(batch.column("lang"), batch.column("phrase"))
            part = limits.searchsorted(_rows(rows[:, :width]), "right") if bounds else np.zeros(len(rows), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), *batch.columns], names=["part", "lang", "phrase", "n"])

    return run


def _windows(lang, phrase) -> np.ndarray:
    raw = b"".join(p.ljust(8 * WORDS, b"\0") for p in phrase.to_pylist())
    return np.column_stack([lang.to_numpy().view(np.uint64), np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, WORDS)])


def _composed(known: pa.Table, asked: pa.Table) -> pa.Table:
    """The weights of the asked phrases in one range: the asked ones' transducer composed with that of the counts."""
    empty = pa.table({"lang": pa.array([], pa.int64()), "phrase": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
    if not known.num_rows or not asked.num_rows:
        return empty

    def built(table: pa.Table) -> tuple[np.ndarray, Transducer]:
        rows = _windows(table.column("lang"), table.column("phrase"))
        order = np.argsort(_rows(rows), kind="stable")
        return order, Transducer.from_sorted(rows[order], table.column("n").to_numpy()[order])

    (_, counts), (order, asks) = built(known), built(asked)
    path, weight = counts.compose(asks)
    chosen = pa.array(order[path])
    return pa.table({"lang": asked.column("lang").take(chosen), "phrase": asked.column("phrase").take(chosen), "n": weight})


def _size(phrase: str = "phrase") -> Column:
    return (F.octet_length(phrase) / 8).cast("int")


def phrase_collocations(
    spark: SparkSession, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, shown: int = SHOWN,
    shard_bytes: int = SHARD_BYTES, range_bytes: int = RANGE_BYTES, filter_bits: int = LARGEST,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's collocations of 2 to 4 words.

    Texts, A-Z lowered, are cut into pieces at ``.,;:!?`` and line ends and
    those into words at blanks and tabs. f counts a phrase's occurrences in
    pieces, n all words of the language (NULL: ``und``). Phrases with
    a = f >= ``least`` are candidates. Cut behind its first k words a
    candidate scores floor(2000000 a / (l + r)), l and r being f of the two
    parts; the lowest counts, of equal ones that of the least k. A candidate
    inside any longer candidate that has at least 80 percent of its
    occurrences goes. ``shown`` rows of a language remain, by score and a
    descending, then phrase in order of bytes. Arithmetic is exact.

    NULL and empty texts have no words; rows count each, whatever their ids or
    copies. Texts are read whole; long ones are cut only between pieces, so a
    single piece must fit a task. Words are told apart by 64-bit hashes. No
    rows, or none frequent enough, give none. Other columns are ignored.
    """
    tables = Tables(spark, "phrases")
    lang_name = F.coalesce(docs[lang_col].cast("string"), F.lit("und"))
    texts = docs.select(F.xxhash64(lang_name).alias("lang"), F.coalesce(docs[text_col].cast("binary"), F.lit(b"")).alias("text"))
    langs = docs.select(F.xxhash64(lang_name).alias("lang"), lang_name.alias("lang_name")).distinct()
    parts = min(power_of_two(text_bytes(docs, text_col) / range_bytes), 1 << 16)
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, docs.count()))

    def counted(seen, levels: range) -> tuple[DataFrame, list[bytes]]:
        bounds = _bounds(spark, texts, seen, share, parts)
        sent = texts.mapInArrow(_shards(seen, _sent(bounds), shard_bytes), "part long, payload binary")
        found = tables.keep(sent.groupBy("part").applyInArrow(_united(least, levels), _COUNTS))
        return found, bounds

    def frequent(found: DataFrame) -> DataFrame:
        summed = found.where("word IS NULL").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        return summed.where((F.col("n") >= least) | (F.octet_length("phrase") == 0))

    found, bounds = counted(None, range(3))
    short = tables.keep(frequent(found))
    table = _filter(spark, short.where("octet_length(phrase) = 16"), filter_bits)
    longer, _ = counted(spark.sparkContext.broadcast(table), range(3, 1 + WORDS))
    words = longer.where("word IS NOT NULL").select(F.col("phrase").alias("key"), F.col("word").cast("string").alias("word")).dropDuplicates(["key"])
    phrases = tables.keep(short.where("octet_length(phrase) > 0").union(frequent(longer)))
    candidates = phrases.where(_size() > 1).withColumnRenamed("n", "a")

    # Each candidate's cuts: the part in front (side 0) and the rest (side 1) for each k.
    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), _size() - 1)))
    sides = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.expr("substring(phrase, 1, 8 * k)").alias("part")),
        F.struct(F.lit(1).alias("side"), F.expr("substring(phrase, 8 * k + 1, length(phrase))").alias("part")),
    ))
    cuts = tables.keep(cuts.select("lang", "phrase", "a", "k", sides.alias("s")).select("lang", "phrase", "a", "k", "s.*"))
    asked = cuts.select("lang", F.col("part").alias("phrase"), F.lit(1).cast("long").alias("n")).distinct()
    routed = "part long, lang long, phrase binary, n long"
    known = phrases.select("lang", "phrase", "n").mapInArrow(_routed(bounds), routed).groupBy("part")
    weights = known.cogroup(asked.mapInArrow(_routed(bounds), routed).groupBy("part")).applyInArrow(_composed, "lang long, phrase binary, n long")
    looked = cuts.join(weights.withColumnRenamed("phrase", "part"), ["lang", "part"])

    weight = lambda side, i: F.max(F.when((F.col("side") == side) & (k == i), F.col("n")))
    split = looked.groupBy("lang", "phrase", "a").agg(*(weight(s, i).alias(f"{x}{i}") for i in range(1, WORDS) for s, x in enumerate("lr")))
    wide = lambda name: F.col(name).cast("decimal(38,0)")
    score = lambda i: F.call_function("div", wide("a") * 2_000_000, wide(f"l{i}") + wide(f"r{i}"))
    best = F.least(*(
        F.when(_size() > i, F.struct(score(i).alias("score"), F.lit(i).alias("k"), F.col(f"l{i}").alias("l"), F.col(f"r{i}").alias("r"))) for i in range(1, WORDS)
    ))
    scored = split.select("lang", "phrase", "a", best.alias("b")).select("lang", "phrase", "a", "b.score", "b.l", "b.r")

    # The most frequent longer candidate around each one.
    inner = F.flatten(F.transform(F.sequence(F.lit(2), _size() - 1), lambda n: F.transform(F.sequence(F.lit(0), _size() - n), lambda i: F.struct(i.alias("i"), n.alias("n")))))
    around = candidates.where(_size() > 2).select("lang", "phrase", "a", F.explode(inner).alias("x"))
    around = around.groupBy("lang", F.expr("substring(phrase, 8 * x.i + 1, 8 * x.n)").alias("phrase")).agg(F.max("a").alias("longer"))
    left = scored.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * INSIDE_PERCENT)).drop("longer")
    left = tables.keep(left)

    spelt = left.select("lang", "phrase", F.explode(F.transform(F.sequence(F.lit(0), _size() - 1), lambda i: F.struct(i.alias("i"), F.substring("phrase", 8 * i + 1, F.lit(8)).alias("key")))).alias("w"))
    spelt = spelt.select("lang", "phrase", "w.*").join(words, "key").groupBy("lang", "phrase").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("words"))
    total = short.where("octet_length(phrase) = 0").select("lang", F.col("n").alias("total"))
    rows = left.join(spelt, ["lang", "phrase"]).withColumn("text", F.array_join(F.col("words.word"), " "))
    ordered = [F.col("score").desc(), F.col("a").desc(), F.col("text")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*ordered)
    few = rows.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= shown)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*ordered))).where(F.col("rank") <= shown)
    result = ranked.join(total, "lang").join(langs, "lang").select(
        F.col("lang_name").alias("lang"), F.col("rank").cast("long").alias("rank"), F.col("text").alias("phrase"), "a", "l", "r", F.col("total").alias("n"), "score",
    )
    result = stored(spark, result, "phrases-result")
    tables.drop()
    return result
