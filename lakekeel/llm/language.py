"""Language identification with a bit-sliced Bloom filter of letter n-grams.

Each position of the filter holds one bit per language, so the positions of an
n-gram, combined by AND, name all languages that contain it at once. The filter
grows with the n-grams put into it: beyond ``LARGEST`` positions it has several
slices, an n-gram lies in one of them, and texts pass by as many slices at a
time as a broadcast may hold. A text's n-grams are counted per language, and
each count is corrected for the false hits that the language's share of set
bits predicts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekeel.llm.payload import mix
from lakekeel.llm.shared import power_of_two, stored

#: Positions of a slice of the filter, least and largest (21 bits of a hash name one), positions for each n-gram, and hashes per n-gram.
POSITIONS, LARGEST, ROOM, HASHES = 1 << 20, 1 << 21, 16, 3
#: Bytes of slices that are broadcast at a time, if one slice isn't more.
BROADCAST = 128 << 20
#: Lengths of the n-grams, word boundaries included.
SIZES = (3, 4)
#: A language contains an n-gram that it uses at least this often against the language that uses it most.
LEAST_SHARE, LEAST_COUNT = 0.3, 2
#: Text bytes whose n-grams are counted at a time, and counts that a task adds up before it sends them.
COUNT_BYTES, COUNTS = 1 << 20, 1 << 19
#: Languages in a word of a position; more take more words.
WORD = 63


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str) -> np.ndarray:
    """Hashes of a text's letter n-grams; a boundary stands for whatever lies between words. Empty without a letter."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return np.empty(0, np.uint64)
    code = np.where(letter, code, 0)
    code = np.r_[0, code[letter | np.r_[False, letter[:-1]]], 0].astype(np.uint64)
    if len(code) > 1 and code[-2] == 0:
        code = code[:-1]
    out = []
    for size in SIZES:
        if len(code) >= size:
            hashed = np.full(len(code) - size + 1, size, np.uint64)
            for i in range(size):
                hashed = hashed * np.uint64(0x100000001B3) + code[i : i + len(hashed)]
            out.append(mix(hashed))
    return np.concatenate(out)


class Shape(NamedTuple):
    """Slices of the filter, positions of each and words of a position."""

    slices: int
    positions: int
    words: int

    def slice_of(self, hashed: np.ndarray) -> np.ndarray:
        return (mix(hashed) % np.uint64(self.slices)).astype(np.int64)

    def places(self, hashed: np.ndarray) -> list[np.ndarray]:
        """The positions of n-grams in their slice."""
        return [((hashed >> np.uint64(21 * i)) & np.uint64(self.positions - 1)).astype(np.int64) for i in range(HASHES)]

    def at_a_time(self) -> int:
        return max(1, BROADCAST // (8 * self.positions * self.words))


def shape(kept: int, languages: int) -> Shape:
    """Room for so many n-grams: at most 3 / 16 of the positions are named for a language."""
    one = power_of_two(ROOM * kept, POSITIONS)
    return Shape(-(-ROOM * kept // LARGEST) if one > LARGEST else 1, min(one, LARGEST), max(1, -(-languages // WORD)))


def learns(doc_id: Column) -> Column:
    """Rows to learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) != 2


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of several counts, with the sum for each."""
    gram, n = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(gram)
    gram = gram[order]
    first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
    return gram[first], np.add.reduceat(n[order], first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each language's n-grams: of some text at a time, added up within the task while they are few enough."""
    texts: dict[str, list[np.ndarray]] = {}
    counts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = held = 0

    def fold() -> int:
        """Text to counts; the number of counts held."""
        for lang, found in texts.items():
            if sum(map(len, found)):
                gram, n = np.unique(np.concatenate(found), return_counts=True)
                counts.setdefault(lang, []).append((gram, n.astype(np.int64)))
        texts.clear()
        return sum(len(gram) for found in counts.values() for gram, _ in found)

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, found in sorted(counts.items()):
            gram, n = _summed(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
        counts.clear()

    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
            text = text.as_py()
            texts.setdefault(lang, []).append(grams(text.decode("utf-8", "replace")))
            size += len(text)
            if size >= COUNT_BYTES:
                size, held = 0, fold()
                if held > 2 * COUNTS:
                    for own, found in counts.items():
                        counts[own] = [_summed(found)]
                    if sum(len(found[0][0]) for found in counts.values()) > COUNTS:
                        yield from rows()
    fold()
    yield from rows()


def _mask(word: int) -> Column:
    """The bits of the languages of a word that contain an n-gram."""
    contains = F.filter("by", lambda x: (x.n >= LEAST_COUNT) & (x.rate >= LEAST_SHARE * F.col("most")) & (F.floor(x.bit / WORD) == word))
    return F.aggregate(contains, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x.bit - word * WORD)))


def fit(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], Shape, DataFrame | None]:
    """The languages (most common first among equals by name), the filter's shape and its set positions, from the rows to learn from."""
    rows = docs.where(learns(docs[id_col].cast("long")) & docs[text_col].isNotNull() & docs[lang_col].isNotNull())
    rows = rows.select(docs[text_col].cast("binary").alias("text"), docs[lang_col].cast("string").alias("lang"))
    counted = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = stored(spark, counted, "lang-grams")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.col("total").desc(), "lang").collect()
    languages = [row.lang for row in totals]
    if not languages:
        return languages, shape(0, 0), None
    known = spark.createDataFrame([(row.lang, i, float(row.total)) for i, row in enumerate(totals)], "lang string, bit int, total double")
    used = counted.join(F.broadcast(known), "lang").select("gram", "n", "bit", (F.col("n") / F.col("total")).alias("rate"))
    most = used.groupBy("gram").agg(F.max("rate").alias("most"), F.collect_list(F.struct("bit", "rate", "n")).alias("by"))
    words = shape(0, len(languages)).words
    names = [f"mask_{w}" for w in range(words)]
    masks = [_mask(w).alias(name) for w, name in enumerate(names)]
    kept = most.select("gram", *masks).where(" OR ".join(f"{n} <> 0" for n in names))
    kept = stored(spark, kept, "lang-kept")
    form = shape(kept.count(), len(languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = batch.column("gram").to_numpy().view(np.uint64)
            nth = form.slice_of(hashed)
            for at in form.places(hashed):
                yield pa.RecordBatch.from_arrays([pa.array(nth), pa.array(at), *(batch.column(n) for n in names)], names=["nth", "at", *names])

    schema = "nth long, at long, " + ", ".join(f"{n} long" for n in names)
    found = kept.mapInArrow(run, schema).groupBy("nth", "at").agg(*(F.bit_or(n).alias(n) for n in names))
    return languages, form, found if form.slices == 1 else stored(spark, found, "lang-filter")


def _slices(form: Shape, found: DataFrame, first: int, stop: int) -> np.ndarray:
    """Slices of the filter, one after the other, with a row for each word."""
    table = np.zeros((form.words, (stop - first) * form.positions), np.int64)
    for nth in range(first, stop):
        part = found.where(F.col("nth") == nth).toArrow()
        at = part.column("at").to_numpy() + (nth - first) * form.positions
        for w in range(form.words):
            table[w, at] = part.column(f"mask_{w}").to_numpy()
    return table


def language_id(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row, by its text alone.

    ``score`` is the language's share of the corrected counts. NULL texts and
    texts without a letter are ``und`` with score 0, and so is every text when
    there is nothing to learn from; letters that no language knows give the
    most common language with score 0. Equal counts go to the more common
    language. Repeated rows are judged alike; a NULL doc_id counts as held out.
    """
    languages, form, found = fit(spark, docs, id_col, text_col, lang_col)
    rows = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        (~F.coalesce(learns(docs[id_col].cast("long")), F.lit(False))).alias("held_out"), docs[text_col].cast("binary").alias("text"),
        F.lit(None).cast("array<double>").alias("counts"),
    )
    starts = range(0, form.slices, form.at_a_time()) if languages else ()
    for first in starts:
        stop = min(first + form.at_a_time(), form.slices)
        table = _slices(form, found, first, stop)
        shared = spark.sparkContext.broadcast(table)
        rows = rows.mapInArrow(_counts(form, first, stop, shared, _false(form, table, len(languages))), rows.schema)
        if stop < form.slices:
            rows = stored(spark, rows, "lang-counts")
            shared.unpersist()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for counts in batch.column("counts").to_pylist():
                if counts is None:
                    names.append("und")
                    scores.append(0.0)
                    continue
                counts = np.clip(counts, 0, None)
                best = int(counts.argmax())
                names.append(languages[best])
                scores.append(float(counts[best] / counts.sum()) if counts.sum() else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.select("doc_id", "held_out", "counts").mapInArrow(judge, "doc_id long, held_out boolean, lang_pred string, score double")


def _false(form: Shape, table: np.ndarray, languages: int) -> np.ndarray:
    """The share of false hits in each slice (rows) for each language."""
    fill = np.empty((table.shape[1] // form.positions, languages))
    for nth in range(len(fill)):
        part = table[:, nth * form.positions : (nth + 1) * form.positions]
        for b in range(languages):
            fill[nth, b] = ((part[b // WORD] >> (b % WORD)) & 1).mean()
    return fill**HASHES


def _counts(form: Shape, first: int, stop: int, shared: Broadcast, false: np.ndarray):
    """Add to each text's counts the hits in some slices, without those expected to be false."""
    languages = false.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            out = []
            for text, before in zip(batch.column("text").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                hashed = grams((text or b"").decode("utf-8", "replace"))
                if not len(hashed):
                    out.append(None)
                    continue
                counts = np.zeros(languages) if before is None else np.array(before)
                nth = form.slice_of(hashed) if form.slices > 1 else np.zeros(len(hashed), np.int64)
                if form.slices > 1:
                    own = (nth >= first) & (nth < stop)
                    hashed, nth = hashed[own], nth[own] - first
                places = [p + nth * form.positions for p in form.places(hashed)]
                looked = np.bincount(nth, minlength=stop - first)
                for w in range(form.words):
                    hit = np.bitwise_and.reduce([table[w, p] for p in places])
                    some, by = hit != 0, slice(w * WORD, min((w + 1) * WORD, languages))
                    for b in range(by.start, by.stop):
                        hits = np.bincount(nth[some][hit[some] >> (b - by.start) & 1 == 1], minlength=stop - first)
                        counts[b] += ((hits - looked * false[:, b]) / (1 - false[:, b])).sum()
                out.append(counts.tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.float64()))], names=["doc_id", "held_out", "text", "counts"])

    return run
