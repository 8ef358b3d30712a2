"""Removal of repeated byte strings by merged Burrows-Wheeler transforms.

Documents are held in blocks. Every 50-byte string has an anchor, the least of
its 24-byte hashes; only strings whose anchor occurs in two documents can
repeat, and all strings of one anchor meet in one part. A part receives the
windows around its anchors (each distinct window once per block, so a passage
of a third of all documents arrives once per block), cuts them into shards and
makes a Burrows-Wheeler transform of each. The transforms are merged by
refining their interleave: step by step the rows are dealt out by the symbols
before them, until rows share 50 bytes exactly where they are still together.
No suffix is compared again. Those repeated intervals give each string the
least document that has it, and each block then cuts its own documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekeel.llm.payload import KEY_BITS, PAYLOAD, PAYLOAD_SCHEMA, mix, packed, unpacked
from lakekeel.llm.shared import power_of_two, stored, text_bytes

#: Length of the strings that count, and of the hashes that anchor them.
WIDTH, ANCHOR = 50, 24
#: Text bytes of a block, and of a shard's transform.
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 1 << 19
#: Text bytes that are hashed together.
CHUNK_BYTES = 128 << 10
#: Anchors that one part compares at a time; the number of parts follows from the data.
PART_ANCHORS = 120_000
#: Ends a window; no byte of UTF-8.
SEPARATOR = 0xFF
_BASE = 0x9E3779B97F4A7C15
_POSITION = 31


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done, step = done + more, step * step % (1 << 64)
    return out


class _Hashes:
    """Hashes of all strings of one length in a text, by a polynomial over byte values."""

    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    ahead, back = _powers(_BASE, 2 * CHUNK_BYTES), _powers(pow(_BASE, -1, 1 << 64), 2 * CHUNK_BYTES)

    def __init__(self, text: np.ndarray):
        n = len(text)
        if n >= len(self.back):
            self.ahead, self.back = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[text] * self.ahead[:n], out=self.sums[1:])

    def at(self, start, stop) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.back[start])


class Windows:
    """The anchored windows of a block: strings ``first`` to ``last`` of document ``doc`` share the anchor ``key``.

    ``content`` is the hash of a window's bytes. Documents are taken some at a
    time, so that the arrays stay in the processor's cache.
    """

    FIELDS = ("first", "last", "doc", "key", "content")

    def __init__(self, text: np.ndarray, lengths: np.ndarray):
        ends = np.cumsum(lengths)
        found: list[tuple] = [tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))]
        doc = 0
        while doc < len(lengths):
            base = int(ends[doc - 1]) if doc else 0
            stop = max(int(np.searchsorted(ends, base + CHUNK_BYTES, "right")), doc + 1)
            found.append(self._chunk(text[base : ends[stop - 1]], lengths[doc:stop], base, doc))
            doc = stop
        for name, values in zip(self.FIELDS, zip(*found, strict=True), strict=True):
            setattr(self, name, np.concatenate(values))

    @staticmethod
    def _chunk(text: np.ndarray, lengths: np.ndarray, base: int, doc: int) -> tuple:
        counts = np.maximum(lengths - WIDTH + 1, 0)
        total = int(counts.sum())
        if not total:
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
        starts = _ranges(np.cumsum(lengths) - lengths, counts)
        hashes = _Hashes(text)
        n = len(text) - ANCHOR + 1
        grams = mix((hashes.sums[ANCHOR:] - hashes.sums[:n]) * hashes.back[:n])
        least = (grams >> np.uint64(_POSITION) << np.uint64(_POSITION)) | np.arange(n, dtype=np.uint64)
        span, wide = 1, WIDTH - ANCHOR + 1
        while 2 * span <= wide:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
        anchor = (least[starts] & np.uint64((1 << _POSITION) - 1)).astype(np.int64)
        # Within one document strings of one anchor follow each other, and no anchor lies in two documents.
        new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        first, last = starts[new], starts[np.r_[new[1:], total] - 1]
        owner = np.searchsorted(np.cumsum(lengths), first, "right")
        # The least of many hashes is a small number; mixed once more, keys fall evenly on the parts.
        return first + base, last + base, owner + doc, mix(grams[anchor[new]]), hashes.at(first, last + WIDTH)

    def only(self, kept: np.ndarray) -> None:
        for name in self.FIELDS:
            setattr(self, name, getattr(self, name)[kept])

    def distinct(self, shift: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order by part and content, the number of each window's content in it, and where contents begin."""
        part = (self.key >> shift).astype(np.int64)
        order = np.lexsort((self.content, part))
        part, content = part[order], self.content[order]
        new = np.r_[True, (content[1:] != content[:-1]) | (part[1:] != part[:-1])] if len(order) else np.empty(0, bool)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return order, number, np.flatnonzero(new)


def _ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.arange(int(lengths.sum())) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)


def _blocks(keep: list[str]):
    """Documents to compressed blocks of rows."""

    def packed_block(batches: list[pa.RecordBatch]) -> bytes:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, batches[0].schema) as writer:
            for batch in batches:
                writer.write_batch(batch)
        return zstandard.compress(out.getvalue().to_pybytes(), 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, rows = TaskContext.get().partitionId() << 24, 0, []
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
            start = 0
            while start < batch.num_rows:
                base = sizes[start - 1] if start else 0
                stop = min(int(np.searchsorted(sizes, base + BLOCK_BYTES - held)) + 1, batch.num_rows)
                rows.append(batch.slice(start, stop - start))
                held += int(sizes[stop - 1] - base)
                start = stop
                if held >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_pylist([{"part": -1, "block": block, "payload": packed_block(rows)}], PAYLOAD_SCHEMA)
                    block, held, rows = block + 1, 0, []
        if rows:
            yield pa.RecordBatch.from_pylist([{"part": -1, "block": block, "payload": packed_block(rows)}], PAYLOAD_SCHEMA)

    return run


def _opened(payload: bytes) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """A block's rows, their ids (a NULL id after all others), whole text and lengths."""
    table = pa.ipc.open_stream(zstandard.decompress(payload)).read_all().combine_chunks()
    ids = table.column(0).fill_null(np.iinfo(np.int64).max).to_numpy()
    texts = table.column(1).combine_chunks()
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    return table, ids, whole, np.diff(offsets).astype(np.int64)


def _anchor_keys(windows: Windows, ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, whether each is in two documents of the block, and the key of each window."""
    keys, inverse = np.unique(windows.key >> np.uint64(64 - bits - KEY_BITS), return_inverse=True)
    low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
    np.minimum.at(low, inverse, ids[windows.doc])
    np.maximum.at(high, inverse, ids[windows.doc])
    return keys, low < high, inverse


def _part_ends(keys: np.ndarray, bits: int) -> list[int]:
    return np.searchsorted(keys, np.arange(1, (1 << bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS)).tolist()


def _anchors(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload"), strict=True):
                _, ids, text, lengths = _opened(payload.as_py())
                keys, several, _ = _anchor_keys(Windows(text, lengths), ids, bits)
                rows, start = [], 0
                for part, end in enumerate(_part_ends(keys, bits)):
                    if end > start:
                        rows.append({"part": part, "block": block, "payload": packed(keys[start:end], several[start:end])})
                    start = end
                yield pa.RecordBatch.from_pylist(rows, PAYLOAD_SCHEMA)

    return run


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """For each block the bits of its anchors in this part that occur in two documents or more."""
    lists = [unpacked(p.as_py()) for p in table.column("payload")]
    keys, inverse = np.unique(np.concatenate([k for k, _ in lists]), return_inverse=True)
    count = np.bincount(inverse, minlength=len(keys)) + np.bincount(inverse, np.concatenate([s for _, s in lists]), len(keys))
    repeated = (count > 1)[inverse]
    cuts = np.cumsum([len(k) for k, _ in lists])[:-1]
    return pa.Table.from_arrays(
        [table.column("part"), table.column("block"), pa.array([np.packbits(r).tobytes() for r in np.split(repeated, cuts)])],
        schema=PAYLOAD_SCHEMA,
    )


def _repeated_windows(parts: dict[int, bytes], ids: np.ndarray, text: np.ndarray, lengths: np.ndarray, bits: int) -> Windows:
    windows = Windows(text, lengths)
    keys, _, inverse = _anchor_keys(windows, ids, bits)
    repeated, start = np.zeros(len(keys), bool), 0
    for part, end in enumerate(_part_ends(keys, bits)):
        if end > start:
            repeated[start:end] = np.unpackbits(np.frombuffer(parts[part], np.uint8), count=end - start)
        start = end
    windows.only(repeated[inverse])
    return windows


def _window_rows(bits: int):
    """A block's distinct windows, to the part of their anchor."""

    def run(table: pa.Table) -> pa.Table:
        payloads = dict(zip(table.column("part").to_pylist(), table.column("payload").to_pylist(), strict=True))
        block = table.column("block")[0].as_py()
        _, ids, text, lengths = _opened(payloads.pop(-1))
        windows = _repeated_windows(payloads, ids, text, lengths, bits)
        order, number, begins = windows.distinct(np.uint64(64 - bits))
        least = np.full(len(begins), np.iinfo(np.int64).max)
        np.minimum.at(least, number, ids[windows.doc])
        shown = order[begins]
        part = (windows.key[shown] >> np.uint64(64 - bits)).astype(np.int64)
        content = windows.content[shown]
        size = windows.last[shown] + WIDTH - windows.first[shown]
        rows = []
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True) if len(part) else ():
            body = text[_ranges(windows.first[shown[a:b]], size[a:b])]
            raw = b"".join((np.int64(b - a).tobytes(), content[a:b].tobytes(), least[a:b].tobytes(), size[a:b].astype("<u2").tobytes(), body.tobytes()))
            rows.append({"part": int(part[a]), "block": block, "payload": zstandard.compress(raw, 1)})
        return pa.Table.from_pylist(rows, PAYLOAD_SCHEMA)

    return run


class Transform:
    """Burrows-Wheeler transform of a shard: for each suffix in order the symbol before it and the row of that suffix."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        ahead = np.r_[text, np.full(64, SEPARATOR, np.uint8)].astype(np.uint64)
        word = np.zeros(n + 56, np.uint64)  # the next 8 bytes at each place
        for i in range(8):
            word = (word << np.uint64(8)) | ahead[i : i + n + 56]
        order = np.argsort(word[:n], kind="stable").astype(np.int32)
        sorted_ = word[order]
        new = np.r_[True, sorted_[1:] != sorted_[:-1]]
        rank = np.cumsum(new, dtype=np.int32)
        for depth in range(8, WIDTH, 5):  # ties by the next 5 bytes, where there are any
            tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
            if not len(tied):
                break
            key = (rank[tied].astype(np.uint64) << np.uint64(40)) | (word[order[tied] + depth] >> np.uint64(24))
            inner = np.argsort(key, kind="stable")
            order[tied] = order[tied][inner]
            key = key[inner]
            new[tied] |= np.r_[True, key[1:] != key[:-1]]
            rank = np.cumsum(new, dtype=np.int32)
        self.row = np.empty(n, np.int32)
        self.row[order] = np.arange(n, dtype=np.int32)
        before = order - 1
        self.symbol, self.back = text[before], self.row[before]


def merge(transforms: list[Transform], rows: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' rows, refined to ``depth`` symbols in front of the given rows.

    Returns for each given row, shard after shard, its place in the merged
    order and the number of its interval: rows of one interval have the same
    ``depth`` symbols before them. ``depth`` is even: two symbols a step. The
    list of transforms is used up.
    """
    base = np.cumsum([0, *(len(t.row) for t in transforms)])[:-1]
    symbol = np.concatenate([t.symbol for t in transforms])
    wide = np.int32 if len(symbol) < 1 << 31 else np.int64
    back = np.concatenate([t.back.astype(wide) + wide(b) for t, b in zip(transforms, base, strict=True)])
    transforms.clear()
    pair = (symbol[back].astype(np.uint16) << 8) | symbol
    back = back[back]
    del symbol
    start = [np.argsort(r, kind="stable").astype(np.int32) for r in rows]
    member = np.concatenate([s + wide(b) for s, b in zip(start, np.cumsum([0, *map(len, rows)])[:-1], strict=True)])
    row = np.concatenate([r[s] + wide(b) for r, s, b in zip(rows, start, base, strict=True)])
    interval = np.zeros(len(row), np.int32)
    for _ in range(depth // 2):
        before = pair[row]
        order = np.argsort(before, kind="stable")
        before, interval = before[order], interval[order]
        row, member = back[row[order]], member[order]
        interval = np.cumsum(np.r_[False, (before[1:] != before[:-1]) | (interval[1:] != interval[:-1])], dtype=np.int32)
    return member, interval


def _least_documents(table: pa.Table) -> pa.Table:
    """For each string of each block's windows in this part, the least document that has it."""
    size_of, content_of, least_of, bodies = [], [], [], []
    for payload in table.column("payload"):
        raw = zstandard.decompress(payload.as_py())
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        content_of.append(np.frombuffer(raw, np.uint64, n, 8))
        least_of.append(np.frombuffer(raw, np.int64, n, 8 + 8 * n))
        size_of.append(np.frombuffer(raw, "<u2", n, 8 + 16 * n).astype(np.int64))
        bodies.append(np.frombuffer(raw, np.uint8, offset=8 + 18 * n))
    del raw
    sizes = np.concatenate(size_of)
    _, first, inverse = np.unique(np.concatenate(content_of), return_index=True, return_inverse=True)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, inverse, np.concatenate(least_of))
    body, begin = np.concatenate(bodies), np.cumsum(sizes) - sizes
    del content_of, least_of, bodies  # what a part came in as
    size = sizes[first]
    strings = size - WIDTH + 1
    shard = (np.cumsum(size + 1) - 1) // SHARD_BYTES
    transforms, rows = [], []
    for s in range(int(shard[-1]) + 1):
        own = np.flatnonzero(shard == s)
        text = np.full(int((size[own] + 1).sum()), SEPARATOR, np.uint8)
        at = np.cumsum(size[own] + 1) - (size[own] + 1)
        text[_ranges(at, size[own])] = body[_ranges(begin[first[own]], size[own])]
        transforms.append(transform := Transform(text))
        rows.append(transform.row[_ranges(at, strings[own]) + WIDTH])
    del body, text, transform
    member, interval = merge(transforms, rows, WIDTH)
    owner = np.repeat(least, strings)[member]
    lowest = np.minimum.reduceat(owner, np.flatnonzero(np.r_[True, interval[1:] != interval[:-1]]))
    answer = np.empty(len(member), np.int64)
    answer[member] = lowest[interval]
    offset = np.cumsum(strings) - strings
    out, done = [], 0
    for block, sizes_ in zip(table.column("block").to_pylist(), size_of, strict=True):
        chosen = inverse[done : done + len(sizes_)]
        done += len(sizes_)
        found = answer[_ranges(offset[chosen], strings[chosen])]
        out.append({"part": table.column("part")[0].as_py() - (1 << 40), "block": block, "payload": zstandard.compress(np.diff(found, prepend=0).tobytes(), 1)})
    return pa.Table.from_pylist(out, PAYLOAD_SCHEMA)


def _cut(bits: int, keep: list[str], schema: pa.Schema):
    """A block's documents without the strings that a smaller document has."""

    def run(table: pa.Table) -> pa.Table:
        payloads = dict(zip(table.column("part").to_pylist(), table.column("payload").to_pylist(), strict=True))
        rows, ids, text, lengths = _opened(payloads.pop(-1))
        windows = _repeated_windows({p: v for p, v in payloads.items() if p >= 0}, ids, text, lengths, bits)
        order, number, begins = windows.distinct(np.uint64(64 - bits))
        found = sorted((p, v) for p, v in payloads.items() if p < 0)
        least = np.concatenate([np.empty(0, np.int64), *(np.cumsum(np.frombuffer(zstandard.decompress(v), np.int64)) for _, v in found)])
        strings = windows.last - windows.first + 1
        offset = np.cumsum(strings[order[begins]]) - strings[order[begins]]
        hit = least[_ranges(offset[number], strings)] < np.repeat(ids[windows.doc], strings)
        start = _ranges(windows.first, strings)[hit]
        edge = np.zeros(len(text) + 1, np.int32)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + WIDTH, -1)
        covered = np.cumsum(edge[:-1]) > 0
        begin = np.cumsum(lengths) - lengths
        opens = covered.copy()
        opens[1:] &= ~covered[:-1]
        heads = begin[lengths > 0]
        opens[heads] = covered[heads]
        removed, spans = (np.diff(np.r_[0, np.cumsum(x)][np.r_[begin, len(text)]]) for x in (covered, opens))
        left = np.r_[0, np.cumsum(lengths - removed)]
        kept = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(left.astype(np.int32)), pa.py_buffer(text[~covered].tobytes())])
        return pa.Table.from_arrays(
            [rows.column(0), pa.array(lengths), pa.array(removed.astype(np.int64)), pa.array(spans.astype(np.int64)), kept, *(rows.column(2 + i) for i in range(len(keep)))],
            schema=schema,
        )

    return run


def bwt_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` for every row, and the columns named in ``keep``.

    Every byte covered by a 50-byte string that also starts in a document with
    a smaller doc_id is removed; ``kept`` is the rest (bytes), ``n_spans`` the
    number of maximal removed runs. Texts are judged as they came in, matches
    never cross documents, and NULL counts as empty. Rows with the same doc_id
    don't remove one another; a row with a NULL doc_id loses what any other
    has, and removes nothing. An empty table gives no rows.
    """
    bits = power_of_two(text_bytes(docs, text_col) / 14 / PART_ANCHORS, 16).bit_length() - 1
    names = [f"keep_{i}" for i in range(len(keep))]
    texts = docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("binary"), F.lit(b"")).alias("text"),
        *(docs[c].alias(n) for c, n in zip(keep, names, strict=True)),
    )
    blocks = stored(spark, texts.mapInArrow(_blocks(names), PAYLOAD), "bwt-blocks", "none")
    anchors = blocks.mapInArrow(_anchors(bits), PAYLOAD).groupBy("part").applyInArrow(_repeated_anchors, PAYLOAD)
    repeated = stored(spark, anchors, "bwt-anchors")
    windows = blocks.union(repeated).groupBy("block").applyInArrow(_window_rows(bits), PAYLOAD)
    least = stored(spark, windows.groupBy("part").applyInArrow(_least_documents, PAYLOAD), "bwt-least", "none")
    columns = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    columns += "".join(f", {n} {texts.schema[n].dataType.simpleString()}" for n in names)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    for n in names:
        schema = schema.append(pa.field(n, _arrow_type(texts.schema[n].dataType)))
    cut = blocks.union(repeated).union(least).groupBy("block").applyInArrow(_cut(bits, names, schema), columns)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept", *(F.col(n).alias(c) for c, n in zip(keep, names, strict=True)))


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


