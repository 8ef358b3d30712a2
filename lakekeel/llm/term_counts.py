"""Counts of terms by group, packed by length, and how far sources of a language stand apart.

Terms are runs of letters. Those of at most 8 bytes are one 64-bit word, those
of at most 16 bytes two; they are sorted by as many 16-bit digits as their
length takes and counted run by run. Longer terms are sorted as bytes, in
buckets of their own. A task adds up what its documents have before it sends
anything, and a part of the terms is added up once more.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakekeel.llm.byte_runs import LOWER, runs, slices
from lakekeel.llm.payload import PAYLOAD, PAYLOAD_SCHEMA, mix
from lakekeel.llm.shared import Tables, power_of_two, stored, text_bytes

#: Text bytes for each part of the terms, and entries that a task adds up at a time.
PART_BYTES, ENTRIES = 4 << 20, 500_000
#: Terms and sources that are compared at a time.
BLOCK_TERMS, TILE_SOURCES = 4096, 256
#: A term counts if so many documents of its language have it; probabilities are in parts of SCALE.
LEAST_DOCUMENTS, SCALE, TERMS_SHOWN = 3, 1_000_000_000, 200

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_OTHER = ~_LETTER
_MASK = np.array([0] + [(1 << 64) - (1 << (64 - 8 * n)) for n in range(1, 9)], np.uint64)


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Stable order by some integer keys, the first one most significant, by 16 bits at a time; equal digits cost nothing."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        for shift in range(0, 8 * key.dtype.itemsize, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


class Entries(NamedTuple):
    """Terms of up to 16 bytes (``high``, ``low``: their bytes, zeros behind) of a group, with occurrences and documents."""

    high: np.ndarray
    low: np.ndarray
    group: np.ndarray
    n: np.ndarray
    documents: np.ndarray

    @classmethod
    def none(cls) -> Entries:
        return cls(np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64))

    @classmethod
    def joined(cls, several: list[Entries]) -> Entries:
        return cls(*(np.concatenate(x) for x in zip(*several, strict=True))) if several else cls.none()

    def added(self) -> Entries:
        """One entry for each term and group, in order."""
        if not len(self.high):
            return self
        order = radix_order([self.high, self.low, self.group])
        high, low, group, n, documents = (x[order] for x in self)
        new = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]) | (group[1:] != group[:-1])])
        return Entries(high[new], low[new], group[new], np.add.reduceat(n, new), np.add.reduceat(documents, new))


Long = dict[tuple[bytes, int], list[int]]


def _put(into: Long, term: bytes, group: int, n: int, documents: int) -> None:
    held = into.setdefault((term, group), [0, 0])
    held[0] += n
    held[1] += documents


def _counted(text: np.ndarray, offsets: np.ndarray, groups: np.ndarray) -> tuple[Entries, Long]:
    """Terms of some documents, which come in the order of their groups."""
    starts, ends = runs(_LETTER[text], offsets)
    doc = np.searchsorted(offsets, starts, "right") - 1
    length = ends - starts
    low = np.r_[LOWER[text], np.zeros(24, np.uint8)].astype(np.uint64)
    word = np.zeros(len(text) + 16, np.uint64)  # the next 8 bytes at each place
    for i in range(8):
        word = (word << np.uint64(8)) | low[i : i + len(word)]
    several = []
    for least in range(1, 17, 2):  # buckets of one length class: short terms take few digits
        own = np.flatnonzero((length == least) | (length == least + 1))
        if not len(own):
            continue
        at, size, of = starts[own], length[own], doc[own]
        high = word[at] & _MASK[np.minimum(size, 8)]
        rest = word[at + 8] & _MASK[size - 8] if least > 8 else np.zeros(len(own), np.uint64)
        order = radix_order([high, rest])
        high, rest, of = high[order], rest[order], of[order]
        group = groups[of]
        new = np.r_[True, (high[1:] != high[:-1]) | (rest[1:] != rest[:-1]) | (group[1:] != group[:-1])]
        first = np.flatnonzero(new)
        documents = np.add.reduceat((new | np.r_[True, of[1:] != of[:-1]]).astype(np.int64), first)
        several.append(Entries(high[first], rest[first], group[first].astype(np.uint32), np.diff(np.r_[first, len(new)]), documents))
    long: Long = {}
    wide = np.flatnonzero(length > 16)
    raw = LOWER[text].tobytes() if len(wide) else b""
    found = sorted((raw[starts[i] : ends[i]], int(doc[i])) for i in wide)
    for (term, of), same in groupby(found):
        _put(long, term, int(groups[of]), sum(1 for _ in same), 1)
    return Entries.joined(several), long


def _gathered(texts: pa.Array, groups: np.ndarray) -> Iterator[tuple[Entries, Long]]:
    """The counts of a column of texts, some documents at a time; a long document is added up before it counts as one."""
    parts, row = [], -1

    def whole() -> tuple[Entries, Long]:
        entries = Entries.joined([e for e, _ in parts]).added()
        long: Long = {}
        for _, own in parts:
            for (term, group), (n, _) in own.items():
                _put(long, term, group, n, 0)
        return entries._replace(documents=np.ones(len(entries.n), np.int64)), {k: [n, 1] for k, (n, _) in long.items()}

    for own in slices(texts, _OTHER):
        if parts and (own.first != row or len(own.offsets) > 2):
            yield whole()
            parts = []
        if len(own.offsets) == 2:  # all of a document, or a part of it
            parts.append(_counted(own.text, own.offsets, groups[own.first : own.first + 1]))
            row = own.first
            continue
        of = groups[own.first : own.first + len(own.offsets) - 1]
        order = np.argsort(of, kind="stable")
        sizes = np.diff(own.offsets)[order]
        moved = np.concatenate([own.text[own.offsets[i] : own.offsets[i + 1]] for i in order])
        yield _counted(moved, np.r_[0, np.cumsum(sizes)], of[order])
    if parts:
        yield whole()


def _hashed(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(high * np.uint64(0x9E3779B97F4A7C15) + mix(low + np.uint64(1)))


def _bytes(entries: Entries, long: list[tuple[bytes, int, int, int]], names: list[tuple[int, int]]) -> bytes:
    """Entries and the (language, group) keys that their groups number, as bytes."""
    used = np.unique(np.r_[entries.group, np.array([g for _, g, _, _ in long], np.uint32)]).astype(np.int64)
    number = np.zeros(int(used.max(initial=-1)) + 1, np.int64)
    number[used] = np.arange(len(used))
    two = entries.low != 0
    table = pa.RecordBatch.from_pydict({
        "names": [[x for g in used for x in names[g]]], "high": [entries.high], "low": [entries.low[two]], "two": [np.flatnonzero(two).astype(np.uint32)],
        "group": [number[entries.group].astype(np.uint16 if len(used) < 1 << 16 else np.uint32)],
        "n": [_narrow(entries.n)], "documents": [_narrow(entries.documents)],
        "term": [[t for t, _, _, _ in long]], "long": [[x for _, g, n, d in long for x in (int(number[g]), n, d)]],
    }, pa.schema([
        ("names", pa.list_(pa.int64())), ("high", pa.list_(pa.uint64())), ("low", pa.list_(pa.uint64())), ("two", pa.list_(pa.uint32())),
        ("group", pa.list_(pa.uint16() if len(used) < 1 << 16 else pa.uint32())),
        ("n", pa.list_(pa.from_numpy_dtype(_narrow(entries.n).dtype))), ("documents", pa.list_(pa.from_numpy_dtype(_narrow(entries.documents).dtype))),
        ("term", pa.list_(pa.binary())), ("long", pa.list_(pa.int64())),
    ]))
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(table)
    return out.getvalue().to_pybytes()


def _narrow(values: np.ndarray) -> np.ndarray:
    most = int(values.max(initial=0))
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.int64)


def _opened(payload: bytes) -> tuple[Entries, list[tuple[bytes, int, int, int]], np.ndarray]:
    table = pa.ipc.open_stream(payload).read_all()
    flat = {c: table.column(c).combine_chunks().flatten() for c in table.column_names}
    high = flat["high"].to_numpy()
    low = np.zeros(len(high), np.uint64)
    low[flat["two"].to_numpy()] = flat["low"].to_numpy()
    entries = Entries(high, low, flat["group"].to_numpy().astype(np.uint32), flat["n"].to_numpy().astype(np.int64), flat["documents"].to_numpy().astype(np.int64))
    numbers = flat["long"].to_numpy().reshape(-1, 3).tolist()
    return entries, [(t, *x) for t, x in zip(flat["term"].to_pylist(), numbers, strict=True)], flat["names"].to_numpy().reshape(-1, 2)


def _shards(bits: int, most: int):
    """Batches ``(lang, grp, text)`` to payloads by part of the terms."""

    def sent(held: list[Entries], long: Long, names: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        entries = Entries.joined(held).added()
        part = (_hashed(entries.high, entries.low) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(entries.n), np.int64)
        order = np.argsort(part.astype(np.uint16), kind="stable")
        entries, part = Entries(*(x[order] for x in entries)), part[order]
        extra: dict[int, list] = {}
        for (term, group), (n, documents) in sorted(long.items()):
            extra.setdefault(hash_bytes(term) >> (64 - bits) if bits else 0, []).append((term, group, n, documents))
        cuts = np.searchsorted(part, np.arange((1 << bits) + 1))
        for p in range(1 << bits):
            own = Entries(*(x[cuts[p] : cuts[p + 1]] for x in entries))
            if len(own.n) or p in extra:
                yield pa.RecordBatch.from_pylist([{"part": p, "block": 0, "payload": _bytes(own, extra.get(p, []), names)}], PAYLOAD_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[tuple[int, int]] = []
        known: dict[tuple[int, int], int] = {}
        held: list[Entries] = []
        long: Long = {}
        size = 0
        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("grp").to_pylist(), strict=True)
            groups = np.array([known.setdefault(p, len(known)) for p in pairs], np.int64)
            names += list(known)[len(names) :]
            for entries, more in _gathered(batch.column("text"), groups):
                held.append(entries)
                size += len(entries.n)
                for (term, group), (n, documents) in more.items():
                    _put(long, term, group, n, documents)
                if size + len(long) > 2 * most:
                    held = [Entries.joined(held).added()]
                    size = len(held[0].n)
                    if size + len(long) > most:
                        yield from sent(held, long, names)
                        held, long, size = [], {}, 0
        if held or long:
            yield from sent(held, long, names)

    return run


def hash_bytes(term: bytes) -> int:
    """The part of a long term: the hash of its words, folded."""
    words = np.frombuffer(term + bytes(-len(term) % 8), np.uint64)
    return int(mix(np.array([int(np.bitwise_xor.reduce(mix(words + np.arange(len(words), dtype=np.uint64)))) + len(term) & (1 << 64) - 1], np.uint64))[0])


_KEPT = "part long, lang long, grp long, term binary, number long, n long, total long, first boolean"


def _kept(table: pa.Table) -> pa.Table:
    """Of one part of the terms, those that enough documents of a language have, with their count in each group and in all."""
    opened = [_opened(p.as_py()) for p in table.column("payload")]
    names = np.concatenate([x for _, _, x in opened])
    langs, lang_of = np.unique(names[:, 0], return_inverse=True)
    groups, first, group_of = np.unique(names[:, 1], return_index=True, return_inverse=True)
    base = np.cumsum([0, *(len(x) for _, _, x in opened)])[:-1]
    entries = Entries.joined([e._replace(group=group_of[e.group + b].astype(np.uint32)) for (e, _, _), b in zip(opened, base, strict=True)]).added()
    lang_of_group = lang_of[first]
    rows: list[tuple[np.ndarray, ...]] = []
    terms: list[bytes] = []

    def keep(same: np.ndarray, group: np.ndarray, n: np.ndarray, documents: np.ndarray) -> np.ndarray:
        """Entries in the order of a term's number ``same``: those to keep, with numbers."""
        lang = lang_of_group[group]
        order = np.lexsort((group, lang, same))
        lang, of = lang[order], same[order]
        new = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (lang[1:] != lang[:-1])]) if len(of) else np.empty(0, np.int64)
        if not len(new):
            return np.empty(0, np.int64)
        size = np.diff(np.r_[new, len(of)])
        enough = np.repeat(np.add.reduceat(documents[order], new) >= LEAST_DOCUMENTS, size)
        total = np.repeat(np.add.reduceat(n[order], new), size)
        one = np.zeros(len(of), bool)
        one[new] = True
        chosen = order[enough]
        rows.append((langs[lang[enough]], groups[group[chosen]], n[chosen], total[enough], one[enough]))
        return chosen

    if len(entries.n):
        new = np.r_[True, (entries.high[1:] != entries.high[:-1]) | (entries.low[1:] != entries.low[:-1])]
        chosen = keep(np.cumsum(new), entries.group.astype(np.int64), entries.n, entries.documents)
        raw = np.stack([entries.high[chosen], entries.low[chosen]], 1).astype(">u8").tobytes()
        terms += [raw[i : i + 16].rstrip(b"\0") for i in range(0, len(raw), 16)]
    long: Long = {}
    for (_, more, _), b in zip(opened, base, strict=True):
        for term, group, n, documents in more:
            _put(long, term, int(group_of[group + b]), n, documents)
    if long:
        found = sorted(long.items())
        number = np.cumsum([i == 0 or found[i][0][0] != found[i - 1][0][0] for i in range(len(found))])
        chosen = keep(number, np.array([k[1] for k, _ in found]), np.array([v[0] for _, v in found]), np.array([v[1] for _, v in found]))
        terms += [found[i][0][0] for i in chosen]
    lang, group, n, total, one = (np.concatenate(x) for x in zip(*rows, strict=True)) if rows else (np.empty(0, np.int64),) * 4 + (np.empty(0, bool),)
    part = np.full(len(lang), table.column("part")[0].as_py())
    number = np.cumsum(one, dtype=np.int64)  # of a language's term, within the part
    return pa.table({"part": part, "lang": lang, "grp": group, "term": pa.array(terms, pa.binary()), "number": number, "n": n, "total": total, "first": one})


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exactly."""
    return F.call_function("div", SCALE * (count.cast("decimal(20,0)") + 1), total.cast("decimal(20,0)") + terms) + 1


def _gain(p: Column, q: Column) -> Column:
    """floor((p - q)² / q): shares are at most SCALE + 1, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def _tile_sums(width: int):
    """Sums of the gains over one block of terms, for each pair of sources of one tile or of two; term -1 tells how many there are."""

    def run(table: pa.Table) -> pa.Table:
        nth, number, n, size, terms, low, high = (table.column(c).to_numpy() for c in ("nth", "number", "n", "size", "terms", "low", "high"))
        sources, at = np.unique(nth, return_inverse=True)
        real, where = np.unique(number, return_inverse=True)
        count, base = np.zeros((len(sources), len(real)), np.int64), np.ones(len(sources), np.int64)
        count[at, where], base[at] = n, size + terms
        absent = int(n[number < 0].max()) - int((real >= 0).sum())  # terms of the block that none of these sources has
        none = 1 + SCALE // base
        top = SCALE * (count + 1) if int(n[number >= 0].max(initial=0)) < 9_000_000_000 else SCALE * (count.astype(object) + 1)
        share = (1 + top // base[:, None]).astype(np.int64)[:, real >= 0]
        tile = sources // width
        pairs, value = [], []
        for i in range(len(sources)):
            others = np.flatnonzero((tile != tile[i]) if low[0] != high[0] else (np.arange(len(sources)) != i))
            pairs.append(np.stack([np.full(len(others), sources[i]), sources[others]]))
            value.append(((share[i] - share[others]) ** 2 // share[others]).sum(1) + absent * ((none[i] - none[others]) ** 2 // none[others]))
        of, other = np.concatenate(pairs, 1)
        return pa.table({"lang": np.full(len(of), table.column("lang")[0].as_py()), "nth": of, "other": other, "value": np.concatenate(value)})

    return run


def source_divergence(
    spark: SparkSession, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", terms_shown: int = TERMS_SHOWN,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how the terms of each language's sources differ.

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lowered. A
    language keeps the V terms that at least three of its rows have. Every
    (lang, source) group, and every language, gives a kept term with count c
    the share p = 1 + floor(10^9 (c + 1) / (N + V)), N being its counts' sum.
    From share q to p the gain is floor((p - q)² / q). Part ``pair``: for each
    other source of the language the sum of the gains over all kept terms, q
    being the other's (0 without kept terms). Part ``term``: the kept terms
    that the group has and uses more than its language does, q being the
    language's, up to rank ``terms_shown``. Ranks go by value descending,
    then item by bytes. All arithmetic is exact.

    NULL text, lang and source count as ''. Rows are documents, whatever their
    ids; repeated rows count each. Texts of any length are read whole. No rows
    give none; a language with one source has no pairs. Other columns are
    ignored.
    """
    tables = Tables(spark, "divergence")
    named = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("lang_name"), F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("source_name"),
        F.coalesce(docs[text_col].cast("binary"), F.lit(b"")).alias("text"),
    ).withColumns({"lang": F.xxhash64("lang_name"), "grp": F.xxhash64("lang_name", "source_name")})
    bits = power_of_two(text_bytes(docs, text_col) / PART_BYTES, 16).bit_length() - 1
    sent = named.select("lang", "grp", "text").mapInArrow(_shards(min(bits, 16), ENTRIES), PAYLOAD)
    kept = tables.keep(sent.groupBy("part").applyInArrow(_kept, _KEPT))

    # A row for each group: its sizes, and its number among the sources of its language.
    sizes = kept.groupBy("lang", "grp").agg(F.sum("n").alias("size"))
    per_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_size"), F.sum(F.col("first").cast("long")).alias("terms"))
    groups = named.select("lang", "grp", "lang_name", "source_name").distinct().join(sizes, ["lang", "grp"], "left").join(per_lang, "lang", "left")
    groups = groups.fillna(0, ["size", "lang_size", "terms"])
    groups = tables.keep(groups.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("source_name")) - 1))

    rows = kept.join(groups, ["lang", "grp"])
    p, q = _share(F.col("n"), F.col("size"), F.col("terms")), _share(F.col("total"), F.col("lang_size"), F.col("terms"))
    gains = rows.withColumns({"p": p, "q": q}).where("p > q").select("grp", "lang_name", "source_name", F.col("term").cast("string").alias("item"), _gain(F.col("p"), F.col("q")).alias("value"))
    ordered = [F.col("value").desc(), F.col("item")]
    salted = Window.partitionBy("grp", F.pmod(F.xxhash64("item"), F.lit(64))).orderBy(*ordered)
    few = gains.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= terms_shown).drop("rank")
    terms = few.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*ordered))).where(F.col("rank") <= terms_shown)
    terms = terms.select("lang_name", "source_name", F.lit("term").alias("part"), "item", "value", "rank")

    # Blocks of terms for each pair of tiles of sources. Every source has a row in each block of its language
    # that tells how many terms it holds, so that terms a source lacks count too.
    tiles = groups.groupBy("lang").agg((F.floor((F.count("*") - 1) / TILE_SOURCES) + 1).cast("int").alias("tiles"))
    blocks = kept.groupBy("lang", "part").agg((F.floor(F.count_if("first") / BLOCK_TERMS) + 1).cast("int").alias("blocks"))
    placed = groups.join(tiles, "lang").select("lang", "grp", "nth", "size", "terms", "tiles")
    cells = kept.select("lang", "grp", "part", "number", "n").join(placed, ["lang", "grp"]).join(blocks, ["lang", "part"])
    cells = cells.withColumn("block", F.pmod("number", "blocks").cast("int"))
    held = kept.where("first").join(blocks, ["lang", "part"]).groupBy("lang", "part", F.pmod("number", "blocks").cast("int").alias("block"))
    every = held.agg(F.count("*").alias("n")).join(placed, "lang").withColumn("number", F.lit(-1).cast("long"))
    columns = ["lang", "part", "block", "nth", "size", "terms", "number", "n", "tiles"]
    tile, against = F.floor(F.col("nth") / TILE_SOURCES).cast("int"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    met = cells.select(*columns).union(every.select(*columns)).withColumn("against", against)
    met = met.withColumns({"low": F.least(tile, "against"), "high": F.greatest(tile, "against")}).drop("against", "tiles")
    sums = met.groupBy("lang", "part", "block", "low", "high").applyInArrow(_tile_sums(TILE_SOURCES), "lang long, nth int, other int, value long")
    value = F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")
    summed = sums.groupBy("lang", "nth", "other").agg(value)
    others = groups.select("lang", F.col("nth").alias("other"), F.col("source_name").alias("item"))
    pairs = groups.select("lang", "grp", "lang_name", "source_name", "nth").join(others, "lang").where("nth <> other").join(summed, ["lang", "nth", "other"], "left").fillna(0, ["value"])
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(*ordered)))
    pairs = pairs.select("lang_name", "source_name", F.lit("pair").alias("part"), "item", "value", "rank")
    result = stored(spark, pairs.union(terms).toDF("lang", "source", "part", "item", "value", "rank"), "divergence-result")
    tables.drop()
    return result
