"""Toxicity by weak supervision.

Voters are whole words (lexicon) and word beginnings (patterns) that are more
common in toxic than in clean labelled documents; counts cover all labelled
documents of the learning folds, and every term with enough evidence votes.
Beginnings that fire on the same documents as their word are one voter with it.
A generative label model then takes the votes without the labels: expectation
maximisation estimates how often each voter fires in either class, and voters
that fire together beyond what the classes explain share their weight. Its
posteriors are the labels of a linear classifier over the votes, which scores
every document. Both are fitted on all labelled rows, as distinct sets of votes
with their number of rows; a step needs only sums per voter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekeel.llm.shared import stored, whole_texts

#: Votes, and pairs of voters, up to this number are summed on the driver (at most some 100 MB); more stay in Spark.
LOCAL = 4_000_000
#: Steps of expectation maximisation, and of the classifier at most.
ROUNDS, STEPS = 50, 200
#: Lengths of word beginnings that are tried as patterns.
BEGINNINGS = (4, 5, 6)
#: Labels up to this number are broadcast (at most some 50 MB); more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
#: Lower bound of the log odds ratio, two standard errors down, that makes a voter.
LEAST_EVIDENCE = 1.0
#: Ridge of the classifier's weights, each term's.
RIDGE = 0.1

_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:n]}" for n in BEGINNINGS if len(word) >= n)]


def _words(text: bytes) -> set[str]:
    return set(_WORD.findall(text.decode("utf-8", "replace").lower()))


def learns(doc_id: Column) -> Column:
    """Rows whose labels may be learned from: crc32 of the id as text, modulo 5, is not 0."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) != 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class with each feature, summed over the batch before the shuffle."""
    known: dict[str, list[str]] = {}
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            found: set[str] = set()
            for word in _words(text):
                if word not in known:
                    known[word] = features(word)
                found.update(known[word])
            counts[toxic].update(found)
        if len(known) > 500_000:
            known.clear()
        keys = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_pydict({
            "feature": keys, "clean": [counts[0][k] for k in keys], "toxic": [counts[1][k] for k in keys],
        }, pa.schema([("feature", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]))


class _Votes(dict):
    """Word to the numbers of the voters it makes fire."""

    def __init__(self, voters: list[str]):
        self.voters = {v: i for i, v in enumerate(voters)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 500_000:
            self.clear()
        fired = tuple(self.voters[f] for f in features(word) if f in self.voters)
        self[word] = fired
        return fired

    def of(self, text: bytes) -> set[int]:
        return {v for fired in map(self.__getitem__, _words(text)) if fired for v in fired}


class Rows:
    """Rows of a stored table, read on the driver if they are few and by tasks otherwise; ``sums`` adds up a kernel over them."""

    def __init__(self, frame: DataFrame, size: int):
        self.frame = frame
        self.local = frame.toArrow().to_batches() if size <= LOCAL else None

    def sums(self, kernel: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
        total = np.zeros(width)
        if self.local is not None:
            for batch in self.local:
                total += kernel(batch)
            return total

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = np.zeros(width)
            for batch in batches:
                part += kernel(batch)
            at = np.flatnonzero(part)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(part[at])], names=["at", "value"])

        found = self.frame.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        total[found.column("at").to_numpy()] = found.column("value").to_numpy()
        return total


def _sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and voter of each vote, and how many documents each row stands for."""
    fired = batch.column("fired")
    lengths = np.diff(fired.offsets.to_numpy())
    return np.repeat(np.arange(len(lengths)), lengths), fired.flatten().to_numpy(), batch.column("n").to_numpy().astype(float)


def _odds(theta: np.ndarray, bias: float, row: np.ndarray, voter: np.ndarray, rows: int) -> np.ndarray:
    return bias + np.bincount(row, theta[voter], rows)


def label_model(votes: Rows, pairs: Rows, prior: float, fires: np.ndarray) -> tuple[np.ndarray, float]:
    """What each vote adds to the log odds of the toxic class, and what they start from.

    ``fires`` (voters, x 2) are the firing rates in the clean and the toxic
    class that the voters were chosen by; expectation maximisation refines
    them from the votes alone, with those rates as prior knowledge worth as
    many rows as there are. A voter that doesn't fire abstains; that all
    abstain is the last voter. Voters that fire together beyond what the
    classes explain share their weight: each has one over the sum of the
    squares of its positive correlations (with itself too) within the classes.
    """
    width = len(fires)
    rates = np.clip(fires, 1e-4, 0.999)
    share = np.ones(width)
    bias = float(np.log(prior / (1 - prior)))

    def fired(batch: pa.RecordBatch) -> np.ndarray:
        row, voter, n = _sparse(batch)
        return np.r_[np.bincount(voter, n[row], width), n.sum()]

    *times, count = votes.sums(fired, width + 1)
    times, known = np.array(times), count * np.array([1 - prior, prior])
    theta = share * np.log(rates[:, 1] / rates[:, 0])
    for step in range(ROUNDS):
        theta = share * np.log(rates[:, 1] / rates[:, 0])

        def expect(batch: pa.RecordBatch, theta: np.ndarray = theta) -> np.ndarray:
            row, voter, n = _sparse(batch)
            posterior = 1 / (1 + np.exp(-np.clip(_odds(theta, bias, row, voter, len(n)), -40, 40)))
            return np.r_[np.bincount(voter, (n * posterior)[row], width), (n * posterior).sum(), (n * posterior**2).sum()]

        *toxic, ones, squares = votes.sums(expect, width + 2)
        both = np.c_[times - toxic, toxic]
        rates = np.clip((both + fires * known) / (np.array([count - ones, ones]) + known), 1e-4, 0.999)
        if step % 10 == 0:
            cross = np.array([[count - 2 * ones + squares, ones - squares], [ones - squares, squares]])
            explained = rates @ cross
            spread = np.sqrt(np.clip((times - 2 * (both * rates).sum(1) + (explained * rates).sum(1)) / count, 1e-9, None))

            def shared(batch: pa.RecordBatch, rates=rates, both=both, explained=explained, spread=spread) -> np.ndarray:
                pair, n = batch.column("pair").to_numpy(), batch.column("n").to_numpy()
                i, j = pair // width, pair % width
                covariance = (n - (both[i] * rates[j]).sum(1) - (both[j] * rates[i]).sum(1) + (explained[i] * rates[j]).sum(1)) / count
                square = np.clip(covariance / (spread[i] * spread[j]), 0, 1) ** 2
                return np.bincount(i, square, width) + np.bincount(j, square, width)

            share = 1 / (1 + pairs.sums(shared, width))
    return theta, bias


def linear_classifier(votes: Rows, theta: np.ndarray, start: float, ridge: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression on the label model's posteriors, the last one the bias; limited-memory quasi-Newton steps."""
    width = len(theta)

    def loss(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def slopes(batch: pa.RecordBatch) -> np.ndarray:
            row, voter, n = _sparse(batch)
            target = 1 / (1 + np.exp(-np.clip(_odds(theta, start, row, voter, len(n)), -40, 40)))
            odds = _odds(np.r_[weights[:-1], 0.0], weights[-1], row, voter, len(n))
            off = n * (1 / (1 + np.exp(-np.clip(odds, -40, 40))) - target)
            return np.r_[np.bincount(voter, off[row], width)[:-1], off.sum(), (n * (np.logaddexp(0, odds) - target * odds)).sum()]

        found = votes.sums(slopes, width + 1)
        return found[-1] + (ridge * weights**2).sum() / 2, found[:-1] + ridge * weights

    weights = np.r_[np.zeros(width - 1), start]
    value, slope = loss(weights)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        if np.abs(slope).max() < 1e-3:
            break
        move, used = -slope, []
        for d, g in reversed(steps):
            used.append((d @ move) / (d @ g))
            move = move - used[-1] * g
        move = move * ((steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(1.0, np.abs(slope).max()))
        for (d, g), a in zip(steps, reversed(used), strict=True):
            move = move + (a - (g @ move) / (d @ g)) * d
        size = 1.0
        while size > 1e-9:
            then, after = loss(weights + size * move)
            if then <= value + 1e-4 * size * (slope @ move):
                break
            size /= 2
        else:
            break
        if size * move @ (after - slope) > 1e-12:
            steps = [*steps[-9:], (size * move, after - slope)]
        weights, value, slope = weights + size * move, then, after
    return weights


def _voters(chosen: list) -> tuple[list[int], int]:
    """The voter of each feature, and their number. A feature is part of every shorter one of its word, so equal counts mean equal documents."""
    number: dict[str, int] = {}
    counts = {row.feature: (row.clean, row.toxic) for row in chosen}
    found = 0
    for feature in sorted(counts, key=lambda f: (f[0] == "=", len(f))):
        longest = len(feature) - 1 - (feature[0] == "^")
        shorter = next((f"^{feature[1 : 1 + n]}" for n in reversed(BEGINNINGS) if n <= longest), None)
        if counts.get(shorter) == counts[feature]:
            number[feature] = number[shorter]
        else:
            number[feature], found = found, found + 1
    return [number[row.feature] for row in chosen], found


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Voters and their weights (the last is the bias), learned from the labelled rows of the learning folds."""
    texts = whole_texts(docs, id_col, text_col)
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    marks = marks.where(learns(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if marks.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    labelled = texts.join(marks, "doc_id")
    counted = labelled.select("text", "toxic").mapInArrow(_count, "feature string, clean long, toxic long")
    counts = stored(spark, counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "tox-counts")
    sizes = {row.toxic: row["count"] for row in labelled.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return [], np.array([-20.0 if clean or not toxic else 20.0])
    ratio = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    chosen = counts.where("toxic >= 3").withColumn("evidence", ratio - 2 * error).where(F.col("evidence") >= LEAST_EVIDENCE).orderBy("feature").collect()
    features_of = [row.feature for row in chosen]
    number, found = _voters(chosen)
    first = {n: row for row, n in zip(reversed(chosen), reversed(number), strict=True)}
    sizes_of = np.bincount(number, minlength=found).astype(float) if found else np.empty(0)
    patterns = labelled.select("text", "toxic").mapInArrow(_fired([first[n].feature for n in range(found)]), "fired array<int>, n long, toxic long")
    patterns = stored(spark, patterns.groupBy("fired").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")), "tox-votes")
    votes = Rows(patterns, patterns.agg(F.sum(F.size("fired"))).first()[0])
    silent = patterns.where(F.element_at("fired", 1) == found).select((F.col("n") - F.col("toxic")) / clean, F.col("toxic") / toxic).first() or (0.0, 0.0)
    fires = np.array([*([first[n].clean / clean, first[n].toxic / toxic] for n in range(found)), silent], float)
    theta, start = label_model(votes, _together(spark, votes, found + 1), toxic / (clean + toxic), fires)
    weights = linear_classifier(votes, theta, start, np.r_[RIDGE / sizes_of, RIDGE])
    return features_of, np.array([*(weights[n] / sizes_of[n] for n in number), weights[-1]])


def _fired(voters: list[str]):
    """Distinct sets of votes with their numbers of rows; the number after the last voter says that all abstain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = _Votes(voters)
        for batch in batches:
            found: dict[tuple[int, ...], list[int]] = {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen = found.setdefault(tuple(sorted(votes.of(text))) or (len(voters),), [0, 0])
                seen[0] += 1
                seen[1] += toxic
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(list, found), pa.list_(pa.int32())), pa.array([n for n, _ in found.values()]), pa.array([t for _, t in found.values()])],
                names=["fired", "n", "toxic"],
            )

    return run


def _together(spark: SparkSession, votes: Rows, width: int) -> Rows:
    """In how many documents each pair of voters fires together, for pairs that do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def summed() -> pa.RecordBatch:
            pair, at = np.unique(np.concatenate([p for p, _ in waiting]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n for _, n in waiting]))
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

        held = 0
        for batch in batches:
            for fired, n in zip(batch.column("fired"), batch.column("n").to_pylist(), strict=True):
                voter = fired.values.to_numpy().astype(np.int64)
                for k in range(len(voter) - 1):
                    pair = voter[k] * width + voter[k + 1 :]
                    waiting.append((pair, np.full(len(pair), float(n))))
                    held += len(pair)
                    if held > 1_000_000:
                        yield summed()
                        held = 0
        if waiting:
            yield summed()

    pairs = votes.frame.mapInArrow(run, "pair long, n double").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = stored(spark, pairs, "tox-pairs")
    return Rows(pairs, pairs.count())


def score(docs: DataFrame, voters: list[str], weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, score)`` of every row, and the columns named in ``keep`` (``doc_id`` may be one of them).

    The score depends on the text alone. NULL and empty texts, and texts
    without any voter, get the score of a document no voter fires on.
    """
    names = [f"keep_{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        votes = _Votes(voters)
        for batch in batches:
            odds = [weights[-1] + sum(weights[v] for v in sorted(votes.of(t))) for t in batch.column("_text").to_pylist()]
            scores = 1 / (1 + np.exp(-np.clip(np.array(odds, float), -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(scores), *(batch.column(2 + i) for i in range(len(names)))], names=["doc_id", "score", *names],
            )

    rows = docs.select(
        docs[id_col].cast("long").alias("_id"), F.coalesce(docs[text_col].cast("binary"), F.lit(b"")).alias("_text"),
        *(docs[c].alias(n) for c, n in zip(keep, names, strict=True)),
    )
    schema = "doc_id long, score double" + "".join(f", {n} {rows.schema[n].dataType.simpleString()}" for n in names)
    scored = rows.mapInArrow(run, schema)
    return scored.select(
        *(["doc_id"] if "doc_id" not in keep else []), "score", *(F.col(n).alias(c) for c, n in zip(keep, names, strict=True))
    )


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row; labels of held-out rows are never read.

    Without labels of both classes every score is that of the only class, 0 if
    there is none. Repeated rows are scored alike; a NULL doc_id counts as held out.
    """
    voters, weights = fit(spark, docs, labels, id_col, text_col)
    scored = score(docs, voters, weights, id_col, text_col)
    return scored.select(
        "doc_id", (~F.coalesce(learns(F.col("doc_id")), F.lit(False))).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
