"""URL filter: a trie over reversed host labels and path segments.

A rule names a host and the beginning of a path. Its place in the trie is the
way from the top level domain down the host's labels and on along the path's
whole segments; what remains of its path is the beginning of the next segment.
A url walks down the trie once and keeps the longest rule on its way. The trie
is broadcast while the measured size of the rules is bounded; more rules are
joined by the places of the trie that a url passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules and their bytes up to which the trie is broadcast.
BROADCAST_RULES, BROADCAST_BYTES = 200_000, 8 << 20
#: A url's host and path.
PARTS = "://([^/?#]*)([^?#]*)"


class Trie:
    """Rules by place; ``ends`` of a place holds the rest of each rule's path and ``lengths`` the rests' lengths."""

    __slots__ = ("labels", "segments", "ends", "lengths")

    def __init__(self) -> None:
        self.labels: dict[str, Trie] = {}
        self.segments: dict[str, Trie] = {}
        self.ends: dict[str, tuple] = {}
        self.lengths: tuple[int, ...] = ()

    def add(self, host: str, path: str, verdict: str) -> None:
        place = self
        for label in reversed(host.split(".")):
            place = place.labels.setdefault(label, Trie())
        *whole, rest = path.split("/")
        for segment in whole:
            place = place.segments.setdefault(segment, Trie())
        place.ends[rest] = (len(host) + len(path), len(host), host + path, verdict)
        place.lengths = tuple({*place.lengths, len(rest)})

    def longest(self, host: str, path: str) -> tuple[str | None, str | None]:
        """The longest rule that fits and its verdict; of equally long ones that of the longer host."""
        best: tuple = (-1, -1, None, None)
        segments = path.split("/")
        place: Trie | None = self
        for label in reversed(host.split(".")):
            place = place.labels.get(label)
            if place is None:
                break
            inner: Trie | None = place
            for segment in segments:
                for n in inner.lengths:
                    found = inner.ends.get(segment[:n]) if n <= len(segment) else None
                    if found and found[:2] > best[:2]:
                        best = found
                inner = inner.segments.get(segment)
                if inner is None:
                    break
        return best[2], best[3]


def _lowered(column):
    return F.translate(column, ascii_uppercase, ascii_lowercase)


def _judged(trie: Trie, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = trie.value
        for batch in batches:
            found = [top.longest(h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            rules, verdicts = pa.array([r for r, _ in found], pa.string()), pa.array([v or default for _, v in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rules, verdicts], names=["page_id", "host", "path", "rule", "verdict"])

    return run


def _joined(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same by a join: a distinct url passes a bounded number of places, as many as the deepest rule has."""
    most = rules.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("labels"), F.max(F.size(F.split("rule_path", "/"))).alias("segments")).first()
    placed = rules.select(
        F.col("rule_host").alias("suffix"), F.regexp_extract("rule_path", "^(?s)(.*/)?", 0).alias("prefix"), "rule_host", "rule_path", "rule_verdict",
    )
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most.labels))), lambda i: F.array_join(F.slice(labels, -i, i), "."))
    depth = F.sequence(F.lit(0), F.least(F.size(segments) - 1, F.lit(most.segments - 1)))
    prefixes = F.transform(depth, lambda i: F.when(i == 0, "").otherwise(F.concat(F.array_join(F.slice(segments, 1, i), "/"), F.lit("/"))))
    distinct = urls.select("host", "path").distinct()
    passed = distinct.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
    fits = passed.join(placed, ["suffix", "prefix"]).where(F.col("path").startswith(F.col("rule_path")))
    length = F.length("rule_host") + F.length("rule_path")
    best = fits.groupBy("host", "path").agg(
        F.max(F.struct(length.alias("length"), F.length("rule_host").alias("host_length"), F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict")).alias("best")
    )
    judged = urls.join(best, ["host", "path"], "left")
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))


def url_filter(
    spark: SparkSession, pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
    most_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``).
    The host lies behind the first ``://`` up to ``/``, ``?``, ``#`` or the
    end, A-Z lowered; the path goes on up to ``?``, ``#`` or the end. A NULL
    url, or one without ``://``, has both empty and fits no rule. A rule fits
    its host and all its subdomains if the path starts with the rule's. The
    longest rule (characters of host and path together, then of the host)
    wins, and of two verdicts for one rule ``block``. ``rule`` is its host and
    path, NULL if none fits; then the verdict is ``default``. Rules without a
    host or with another verdict count as absent, a NULL path as empty.
    Repeated rows and NULL ids are judged like any others, urls of any length
    whole; no rows give none, and other columns are ignored. Beyond
    ``most_rules`` rules or ``BROADCAST_BYTES`` the rules are joined instead
    of broadcast, with the same result.
    """
    known = rules.select(
        _lowered(rules["host"]).alias("rule_host"), F.coalesce(rules["path"], F.lit("")).alias("rule_path"), rules["verdict"].alias("rule_verdict"),
    ).where("rule_host <> '' AND rule_verdict IN ('allow', 'block')")
    known = known.groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))  # block comes last
    size = known.agg(F.count("*").alias("rules"), F.sum(F.octet_length("rule_host") + F.octet_length("rule_path")).alias("bytes")).first()
    url = F.coalesce(pages[url_col], F.lit(""))
    urls = pages.select(
        pages[id_col].cast("long").alias("page_id"), _lowered(F.regexp_extract(url, PARTS, 1)).alias("host"), F.regexp_extract(url, PARTS, 2).alias("path"),
    )
    if size.rules > most_rules or (size.bytes or 0) > BROADCAST_BYTES:
        return _joined(urls, known, default)
    trie = Trie()
    for rule in known.collect():
        trie.add(rule.rule_host, rule.rule_path, rule.rule_verdict)
    return urls.mapInArrow(_judged(spark.sparkContext.broadcast(trie), default), "page_id long, host string, path string, rule string, verdict string")
