"""Document fingerprints that are invertible Bloom lookup sketches of paragraphs.

A paragraph is a line, or a sentence of it. Its digest goes to one cell of each
of three sub-tables; a cell holds the number, the XOR of the digests and the
XOR of their check values. A fingerprint is the sketch of a text's digests, of
the first size of a ladder at which peeling recovers all of them: a cell with a
single digest names it, and taking it out of its other cells leaves more such
cells. What a fingerprint says of its text is thus whole, and depends on
nothing but the text.

Two fingerprints are compared by subtracting their sketches, brought to a
common size, and peeling the difference, which recovers the paragraphs that
only one text has; pairs whose difference leaves cells over are tried again
with four times the cells.

Everything is DataFrame operations. Texts are shuffled once, by ranges of
doc_id, where the next document lies beside; digests are kept in a table
bucketed by those ranges, so that no cell is ever shuffled.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakekeel.llm.shared import stored
from lakekeel.session import workspace

#: Cells of a sub-table for each digest and besides, at first, and how many times as many each retry has.
CELLS_A_DIGEST, CELLS_BESIDES, LARGER = 0.5, 4, 4
#: Rounds of peeling, each over the three sub-tables; what isn't peeled by then is tried again with a larger sketch.
ROUNDS = 4
#: Ranges of doc_id for each shuffle partition, and at most.
RANGES_A_PARTITION, RANGES = 4, 16_384

OWN, EDITED, NEXT = 0, 1, 2
#: Stands for a NULL id.
NO_ID = -(1 << 63)

_BY = ["range", "row", "kind", "size"]


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs; blank ones don't count."""
    parts = F.filter(F.split(text, r"\n+|(?<=[.!?])\s+"), lambda p: F.trim(p) != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def _cells_for(keys: str) -> str:
    """Cells of a sub-table at the first size of the ladder."""
    return f"cast(ceil(size({keys}) * {CELLS_A_DIGEST}) AS int) + {CELLS_BESIDES}"


def _place(table: int) -> str:
    return f"cast(pmod(xxhash64(key, {table}), size) AS int) + {table} * size"


_CHECK = "xxhash64(key, -1L)"


def _ranged(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(range, id, h, text, own)``: rows in the order of ids, those of one id by their text's hash, cut into ranges.

    The bounds are quantiles of the ids; an id that is several of them is cut by hash.
    """
    rows = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    wanted = min(RANGES_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")), RANGES)
    shares = [i / wanted for i in range(1, wanted)]
    found = rows.agg(F.percentile_approx("id", shares, 100 * wanted).alias("bounds")).first().bounds or []
    step = int(len(found) ** 0.5) + 1
    chunks = [found[i : i + step] for i in range(0, len(found), step)] or [[]]
    known = lambda values, kind: F.from_json(F.lit(json.dumps(values)), kind)

    def before(also: bool) -> Column:
        """How many bounds come before an id, or are it too: whole chunks, then those of one chunk."""
        holds = (lambda x: x <= F.col("id")) if also else (lambda x: x < F.col("id"))
        chunk = F.size(F.filter(known([c[0] for c in chunks[1:]], "array<bigint>"), holds))
        return chunk * step + F.size(F.filter(F.get(known(chunks, "array<array<bigint>>"), chunk), holds))

    spread = F.floor((F.col("h") / float(1 << 64) + 0.5) * (F.col("upto") - F.col("under") + 1))
    place = F.col("under") + F.least(spread, F.col("upto") - F.col("under"))
    cut = rows.withColumns({"under": before(False), "upto": before(True)}).withColumn("range", place.cast("int")).drop("under", "upto")
    return cut.withColumn("own", digests(F.col("text")))


def _versions(rows: DataFrame) -> DataFrame:
    """Each document with the digests of its text, of its edited text and of the next document's text."""
    tops = rows.groupBy("range").agg(F.max(F.struct("id", "h")).alias("top"))  # one row per range
    below = F.lag(F.struct("range", "top")).over(Window.orderBy("range"))
    highest = F.last(F.struct("range", "top")).over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tops = tops.select(F.col("range").alias("for_range"), F.coalesce(below, highest).alias("next")).select("for_range", "next.range", "next.top.id", "next.top.h")
    first = rows.join(F.broadcast(tops), ["range", "id", "h"])  # at most as many as there are ranges, but for equal rows
    first = first.groupBy("for_range").agg(F.first("text").alias("top_text"), F.first("own").alias("top_own")).withColumnRenamed("for_range", "range")
    order = Window.partitionBy("range").orderBy(F.col("id").desc(), F.col("h").desc())
    beside = rows.withColumns({"next_text": F.lead("text").over(order), "next": F.lead("own").over(order)})
    found = beside.join(first, "range", "left")
    front = "substring(coalesce(next_text, top_text), 1, cast(floor(length(text) / 2) AS int))"
    edited = F.expr(f"concat(substring(text, 1, length(text) - cast(floor(length(text) / 2) AS int)), {front})")
    found = found.select("range", "id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited_text"), "own", F.coalesce("next", "top_own").alias("next"))
    return found.select(
        "range", F.monotonically_increasing_id().alias("row"), "id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "own",
        digests(F.col("edited_text")).alias("edited"), "next",
    )


def _added(rows: DataFrame) -> DataFrame:
    """Cells with equal place added up; empty ones are gone."""
    added = rows.groupBy(*_BY, "cell").agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))
    return added.where("n <> 0 OR key <> 0 OR check <> 0")


def sketched(rows: DataFrame) -> DataFrame:
    """Digests ``(range, row, kind, size, sign, key)`` as the cells of their sketch; of opposite signs, as those of the difference."""
    cells = ", ".join(_place(t) for t in range(3))
    return _added(rows.selectExpr(*_BY, "cast(sign AS long) AS n", "key", f"{_CHECK} AS check", f"explode(array({cells})) AS cell"))


def peeled(cells: DataFrame) -> DataFrame:
    """``(range, row, kind, size, first, second, left)``: digests recovered of either text, and cells that were left over."""
    for step in range(3 * ROUNDS):
        table = step % 3  # one sub-table at a time, so that no digest is taken out twice
        pure = f"cell >= {table} * size AND cell < {table + 1} * size AND abs(n) = 1 AND check = {_CHECK}"
        out = [f"named_struct('cell', {_place(t)}, 'n', -n, 'key', key, 'check', check)" for t in range(3) if t != table]
        # Cells -1 and -2 count what was recovered of the first and of the second text.
        found = "named_struct('cell', if(n > 0, -1, -2), 'n', 1L, 'key', 0L, 'check', 0L)"
        stays = "named_struct('cell', cell, 'n', n, 'key', key, 'check', check)"
        moved = cells.selectExpr(*_BY, f"explode(if({pure}, array({', '.join(out)}, {found}), array({stays}))) AS c")
        cells = _added(moved.selectExpr(*_BY, "c.*"))
    count = lambda mark: F.expr(f"sum(if(cell = {mark}, n, 0L))")
    return cells.groupBy(*_BY).agg(count(-1).alias("first"), count(-2).alias("second"), F.expr("sum(if(cell >= 0, 1L, 0L))").alias("left"))


def _results(spark: SparkSession, sides: DataFrame) -> Iterator[DataFrame]:
    """What peeling recovers of each (range, row, kind), sketches growing until nothing is left over.

    ``sides``: ``(range, row, kind, size, sign, keys)``, ``size`` being the first to try.
    """
    sides, failed, factor = sides.where("size(keys) > 0"), None, 1
    while True:
        rows = sides if failed is None else sides.join(failed, ["range", "row", "kind"], "left_semi")
        rows = rows.selectExpr("range", "row", "kind", f"size * {factor} AS size", "sign", "explode(keys) AS key")
        result = stored(spark, peeled(sketched(rows)), "iblt-peeled")
        yield result.where("left = 0")
        failed = result.where("left > 0").select("range", "row", "kind")
        if failed.isEmpty():
            return
        factor *= LARGER


def _all(results: Iterator[DataFrame]) -> DataFrame:
    found = next(results)
    for more in results:
        found = found.union(more)
    return found


def _sides(versions: DataFrame, kinds: list[tuple[int, str, list[tuple[int, str]]]]) -> DataFrame:
    """A row for each side ``(sign, keys)`` of each kind, with the size to try first."""
    made = [f"named_struct('kind', {kind}, 'size', {size}, 'sign', {sign}, 'keys', {keys})" for kind, size, sides in kinds for sign, keys in sides]
    return versions.selectExpr("range", "row", f"inline(array({', '.join(made)}))")


def _fingerprints(versions: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each sketch as text: cells of a sub-table, then the non-empty cells in order (4 bytes place, 4 number, 8 XOR of digests, 4 of checks)."""
    # Joined by row alone, so that cells and strings stay where the digests are.
    size_of = [F.max(F.when(F.col("kind") == k, F.col("size"))).alias(c) for k, c in ((OWN, "own_size"), (EDITED, "edited_size"))]
    sized = versions.select("range", "row", "own", "edited").join(sizes.groupBy("range", "row").agg(*size_of), ["range", "row"])
    both = _sides(sized, [(OWN, "own_size", [(1, "own")]), (EDITED, "edited_size", [(1, "edited")])]).where("size(keys) > 0")
    rows = both.selectExpr(*_BY, "sign", "explode(keys) AS key")
    record = "concat(lpad(hex(cell), 8, '0'), lpad(hex(n), 8, '0'), lpad(hex(key), 16, '0'), substring(lpad(hex(check), 16, '0'), 9, 8))"
    cells = sketched(rows).selectExpr(*_BY, f"{record} AS record").groupBy(*_BY).agg(F.sort_array(F.collect_list("record")).alias("records"))
    text = "concat(size, ':', replace(base64(unhex(array_join(records, ''))), '\\r\\n', ''))"
    shown = cells.selectExpr("range", "row", "kind", f"{text} AS shown").groupBy("range", "row")
    return shown.agg(*(F.max(F.when(F.col("kind") == k, F.col("shown"))).alias(c) for k, c in ((OWN, "fingerprint"), (EDITED, "edited_fingerprint"))))


def iblt_fingerprints(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row's text and edited text, and the likeness of fingerprints.

    Returns ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``. The edited text has the last floor(n_chars / 2)
    code points replaced by the first as many (or all) of the next document in
    descending doc_id; after the least comes the largest. Likeness is the share
    of common paragraphs in all paragraphs of two texts, the difference being
    what peeling recovers; two texts without paragraphs are alike (1). It
    follows from the two fingerprints alone.

    NULL counts as empty, and a text without paragraphs has the empty string as
    fingerprint. Rows with equal doc_id follow each other by their text's hash,
    equal rows in any order (they are each other's next, with equal results but
    for the last); rows with a NULL doc_id come after all others. Long texts
    have larger sketches; a range's widest rows must fit a task. An empty table
    gives no rows. Other columns are ignored.
    """
    table = f"iblt_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _versions(_ranged(spark, docs, id_col, text_col)).write.bucketBy(buckets, "range").option("path", workspace(spark, "iblt")).option(
        "compression", "zstd"
    ).saveAsTable(table)
    versions = spark.table(table)

    own = [(OWN, _cells_for("own"), [(1, "own")]), (EDITED, _cells_for("edited"), [(1, "edited")])]
    sizes = stored(spark, _all(_results(spark, _sides(versions, own))), "iblt-sizes")
    pairs = [(kind, f"{_cells_for('own')} + {_cells_for(other)}", [(1, "own"), (-1, other)]) for kind, other in ((EDITED, "edited"), (NEXT, "next"))]
    found = _all(_results(spark, _sides(versions, pairs)))
    apart = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("first") + F.col("second")))
    found = found.groupBy("range", "row").agg(apart(EDITED).alias("d_edited"), apart(NEXT).alias("d_next"))

    def likeness(other: str, differing: str) -> Column:
        both, apart_ = F.size("own") + F.size(other), F.coalesce(differing, F.lit(0))
        return F.when(both == 0, 1.0).otherwise((both - apart_) / (both + apart_))

    joined = versions.join(found, ["range", "row"], "left").join(_fingerprints(versions, sizes), ["range", "row"], "left")
    shown = joined.select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "n_chars", "edited_sha256", F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
        likeness("edited", "d_edited").alias("near_edited"), likeness("next", "d_next").alias("near_next"),
    )
    spark.sql(f"DROP TABLE {table}")  # its files stay for the rows above
    return shown
