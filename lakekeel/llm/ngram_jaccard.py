"""Similarity join on word n-grams by vertical partitioning.

The global order of n-grams is cut into fragments. Every task turns its
documents into sorted n-gram postings and sends each fragment its share; a
fragment counts in how many documents each n-gram occurs. N-grams of one
document alone can't be part of an overlap, so only the others go back, and a
document whose shared n-grams are too few for the threshold is out. The rest
are candidates through the rarest of their shared n-grams. A candidate pair's
overlap is counted fragment by fragment and summed per pair.

Documents with equal sets are one vertex, and a candidate is first compared
with a few centres of its n-grams at a time, so a group of m near copies costs
some m comparisons a round. Centres are documents whose n-grams many others have.
All pairs that share a rare n-gram and are not connected yet follow, so no link
between unconnected documents is lost; where many are left, each side's overlap
with a pivot, the centre of the n-gram's largest component, bounds theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakekeel.llm.components import connected_components
from lakekeel.llm.payload import KEY_BITS, PAYLOAD, PAYLOAD_SCHEMA, mix, packed, unpacked
from lakekeel.llm.shared import Tables, enough_tasks, power_of_two, stored, text_bytes, whole_texts

#: Text bytes and documents that a task gathers into one block of postings.
BLOCK_BYTES, BLOCK_DOCS = 8 << 20, 1 << 16
#: Documents that a task is handed at a time.
BATCH_ROWS = 1_000
#: N-grams that one fragment counts at a time; the number of fragments follows from the data.
FRAGMENT_NGRAMS = 1_000_000
#: Fragments into which overlaps are split for counting.
OVERLAP_FRAGMENTS = 2
#: Ranges of the n-gram order for which a document keeps how many of its n-grams lie there.
RANGES = 64
#: Pairs for each open row at which all pairs are compared at once, and the share of a round's comparisons that must
#: connect something for there to be another; neither changes the result.
PAIRS_A_ROW, FEW = 2, 0.02
#: Centres that a document is compared with in a round, after one in the first, and the weight of an n-gram of one document.
CENTRES, WEIGHT = 2, 1 << 30
#: A later round's centre is the best of a part of its component's documents, so that rounds differ.
PARTS = 4

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_VERTICES = "vertex long, n long, common int, digest binary, doc_ids array<long>, prefix array<long>, held array<int>, segments array<array<long>>"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ngram_hashes(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams; fewer words than ``size`` are one n-gram."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    grams = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        grams = grams * _FACTOR + hashed[i : i + len(grams)]
    return np.unique(mix(grams + np.uint64(width)))


def need(n, percent: int):
    """Least overlap of a set of n n-grams with any set as similar as ``percent``."""
    return -(-n * percent // 100)


def _postings(size: int, bits: int):
    """Batches of documents to one header and one posting list per fragment for each block."""
    shift = np.uint64(64 - bits - KEY_BITS)

    def block_rows(block: int, ids: list, names: list, sets: dict[bytes, np.ndarray]) -> Iterator[dict]:
        place = {name: i for i, name in enumerate(sets)}
        vertex = np.array([place[name] for name in names], np.int64)
        distinct = list(sets.values())
        counts = np.array([len(s) for s in distinct], np.int64)
        header = pa.BufferOutputStream()
        table = pa.table({"doc_id": pa.array(ids, pa.int64()), "vertex": vertex, "n": counts[vertex], "digest": pa.array(names, pa.binary())})
        with pa.ipc.new_stream(header, table.schema) as out:
            out.write_table(table)
        yield {"part": -1 - block, "block": block, "payload": header.getvalue().to_pybytes()}
        keys = np.concatenate(distinct) if distinct else np.empty(0, np.uint64)
        del distinct
        sets.clear()
        keys >>= shift
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], np.repeat(np.arange(len(counts), dtype=np.uint16), counts)[order]
        del order
        ends = np.searchsorted(keys, np.arange(1, (1 << bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS))
        start = 0
        for part, end in enumerate(ends.tolist()):
            if end > start:
                yield {"part": part, "block": block, "payload": packed(keys[start:end], owner[start:end])}
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 16
        block, held, ids, names, sets = 0, 0, [], [], {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                found = ngram_hashes(text, size)
                ids.append(doc_id)
                names.append(xxhash.xxh3_128_digest(found.tobytes()))
                sets.setdefault(names[-1], found)
                held += len(text)
                if held >= BLOCK_BYTES or len(ids) == BLOCK_DOCS:
                    for row in block_rows(first + block, ids, names, sets):
                        yield pa.RecordBatch.from_pylist([row], PAYLOAD_SCHEMA)
                    block, held, ids, names, sets = block + 1, 0, [], [], {}
        if ids:
            for row in block_rows(first + block, ids, names, sets):
                yield pa.RecordBatch.from_pylist([row], PAYLOAD_SCHEMA)

    return run


def _shared_in_fragment(table: pa.Table) -> pa.Table:
    """Of one fragment, each block's n-grams that occur in two documents or more, with that number; headers pass."""
    if table.column("part")[0].as_py() < 0:
        return table
    lists = [unpacked(p.as_py()) for p in table.column("payload")]
    blocks = table.column("block").to_numpy()
    keys = np.concatenate([k for k, _ in lists])
    origin = np.repeat(np.arange(len(lists), dtype=np.int32), [len(k) for k, _ in lists])
    owner = np.concatenate([o for _, o in lists])
    order = np.argsort(keys, kind="stable")
    keys, origin, owner = keys[order], origin[order], owner[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts = np.diff(np.r_[starts, len(keys)])
    df = np.repeat(counts, counts)
    kept = df > 1
    keys, origin, owner, df = keys[kept], origin[kept], owner[kept], df[kept]
    order = np.argsort(origin, kind="stable")
    keys, origin, owner, df = keys[order], origin[order], owner[order], df[order]
    ends = np.searchsorted(origin, np.arange(1, len(lists) + 1))
    rows, start = [], 0
    for i, end in enumerate(ends.tolist()):
        if end > start:
            body = packed(keys[start:end], owner[start:end])
            rows.append({"part": 0, "block": int(blocks[i]), "payload": body + df[start:end].astype("<u4").tobytes()})
        start = end
    return pa.Table.from_pylist(rows, PAYLOAD_SCHEMA)


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.r_[0, np.cumsum(lengths)].astype(np.int32), pa.array(values))


def _vertices(percent: int, fragments: int, bits: int):
    """One block's documents as vertices; those that can still be similar to another carry their shared n-grams."""
    shift = bits + KEY_BITS - (fragments.bit_length() - 1)

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        keys, owner, df, header = [np.empty(0, np.uint64)], [np.empty(0, np.uint16)], [np.empty(0, np.uint32)], None
        for part, payload in zip(table.column("part").to_pylist(), table.column("payload"), strict=True):
            payload = payload.as_py()
            if part < 0:
                header = pa.ipc.open_stream(payload).read_all()
                continue
            k, o = unpacked(payload)
            keys.append(k)
            owner.append(o)
            df.append(np.frombuffer(payload, "<u4", len(k), len(payload) - 4 * len(k)))
        keys, owner, df = np.concatenate(keys), np.concatenate(owner).astype(np.int64), np.concatenate(df)
        vertex, counts = header.column("vertex").to_numpy(), header.column("n").to_numpy()
        size = int(vertex.max()) + 1
        n = np.zeros(size, np.int64)
        n[vertex] = counts
        shared = np.bincount(owner, minlength=size)
        common = 1000 * np.bincount(owner, weights=np.log2(df), minlength=size) / np.maximum(n, 1)
        alive = (n > 0) & (shared >= need(n, percent))
        kept = alive[owner]
        keys, owner, df = keys[kept], owner[kept], df[kept]
        order = np.lexsort((keys, df, owner))
        ranked, of = keys[order].astype(np.int64), owner[order]
        shared = np.where(alive, shared, 0)
        begins = np.cumsum(shared) - shared
        front = np.arange(len(of)) - begins[of] <= (shared - need(n, percent))[of]
        prefix = _lists(ranked[front], np.bincount(of[front], minlength=size))
        order = np.lexsort((keys, owner))
        keys, owner = keys[order], owner[order]
        cell = owner * fragments + (keys >> np.uint64(shift)).astype(np.int64)
        inner = _lists(keys.astype(np.int64), np.bincount(cell, minlength=size * fragments))
        outer = np.arange(size + 1, dtype=np.int32) * fragments
        ranges = owner * RANGES + (keys >> np.uint64(bits + KEY_BITS - (RANGES.bit_length() - 1))).astype(np.int64)
        held = _lists(np.bincount(ranges, minlength=size * RANGES).astype(np.int32), np.full(size, RANGES))
        order = np.argsort(vertex, kind="stable")
        members = np.bincount(vertex, minlength=size)
        ids = _lists(header.column("doc_id").combine_chunks().take(pa.array(order)), members)
        digest = header.column("digest").combine_chunks().take(pa.array(order[np.cumsum(members) - members]))
        return pa.table({
            "vertex": (block << 20) + np.arange(size), "n": n, "common": common.astype(np.int32), "digest": digest, "doc_ids": ids, "prefix": prefix, "held": held,
            "segments": pa.ListArray.from_arrays(outer, inner),
        })

    return run


def _possible(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """Pairs that can be similar enough: a range of the order has no more n-grams in common than either side holds there."""
    sides = (heads.select(F.col("vertex").alias(x), F.col("n").alias(f"n{x}"), F.col("held").alias(f"h{x}")) for x in "uv")
    for side in sides:
        pairs = pairs.join(side, side.columns[0])
    most = F.expr("aggregate(zip_with(hu, hv, (a, b) -> least(a, b)), 0, (total, x) -> total + x)")
    bounded = pairs.withColumn("most", most).where(f"{100 + percent} * most >= {percent} * (nu + nv)")
    return bounded.select("u", "v", "lu", "lv")


def _overlaps(pairs: DataFrame, vertices: DataFrame) -> DataFrame:
    """Pairs (u, v) with the sizes of both sets and what they have in common, if anything: counted in each fragment, then summed."""
    cells = vertices.select("vertex", "n", F.posexplode("segments").alias("fragment", "grams")).where("size(grams) > 0")
    left = pairs.join(cells.withColumnRenamed("vertex", "u"), "u")
    right = cells.select(F.col("vertex").alias("v"), F.col("n").alias("nv"), "fragment", F.col("grams").alias("other"))
    part = left.join(right, ["v", "fragment"]).select(
        *pairs.columns, "n", "nv", F.size(F.array_intersect("grams", "other")).alias("overlap")
    )
    return part.groupBy(*pairs.columns, "n", "nv").agg(F.sum("overlap").alias("overlap"))


def _linked(pairs: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """Labels (lu, lv) of the pairs (u, v) that are similar enough."""
    return _overlaps(pairs, vertices).where(F.expr(f"100 * overlap >= {percent} * (n + nv - overlap)")).select("lu", "lv")


def _with_pivots(rows: DataFrame, heads: DataFrame, names: DataFrame, vertices: DataFrame) -> DataFrame:
    """Rows of n-grams with how many n-grams their document shares with the n-gram's pivot (``inside``) and with others only.

    The pivot is the centre of the largest component that has the n-gram, so a
    document has some one pivot for each large component it is to be compared with.
    """
    best = F.max(F.struct("common", "vertex"))["vertex"].alias("pivot")
    hubs = heads.select("vertex", "common").join(names, "vertex").groupBy("label").agg(best)
    largest = rows.groupBy("gram").agg(F.max(F.struct("of", "label"))["label"].alias("label"))
    pivots = largest.join(hubs, "label").select("gram", "pivot")
    held = rows.drop("inside", "beside").join(pivots, "gram")
    asked = held.select(F.col("vertex").alias("u"), F.col("pivot").alias("v")).distinct()
    known = _overlaps(asked, vertices).select(F.col("u").alias("vertex"), F.col("v").alias("pivot"), F.col("overlap").alias("inside"))
    found = held.join(known, ["vertex", "pivot"], "left").join(heads.select("vertex", "shared"), "vertex")
    inside = F.coalesce("inside", F.lit(0).cast("long"))
    return found.select(*rows.drop("inside", "beside").columns, inside.alias("inside"), (F.col("shared") - inside).alias("beside"))


def _merged(spark: SparkSession, names: DataFrame, links: DataFrame, tasks: int) -> DataFrame:
    """``(vertex, label)`` after links between labels: a linked label gives way to the least it reaches."""
    parts = connected_components(spark, links.toDF("u", "v"), tasks).withColumnRenamed("vertex", "label")
    return names.join(parts, "label", "left").select("vertex", F.coalesce("component", "label").alias("label"))


def ngram_jaccard(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: each row's set size and the least doc_id reachable by similarity links.

    A document's set holds the distinct n-grams of ``size`` words (A-Z lowered,
    cut at ASCII white space), with fewer words the whole sequence. Two sets
    link when 100 * intersection >= percent * union. NULL, empty and blank
    texts have set size 0 and link with nothing, not even one another. Rows
    with equal doc_id are separate documents; a NULL doc_id counts in its
    component but never names it (a component of such rows alone has a NULL
    name). An empty table gives no rows. Other columns are ignored.
    """
    bits = power_of_two(text_bytes(docs, text_col) / 6 / FRAGMENT_NGRAMS, 16).bit_length() - 1
    texts = whole_texts(docs, id_col, text_col)
    counted = (
        texts.mapInArrow(_postings(size, bits), PAYLOAD)
        .groupBy("part").applyInArrow(_shared_in_fragment, PAYLOAD)
        .groupBy("block").applyInArrow(_vertices(percent, OVERLAP_FRAGMENTS, bits), _VERTICES)
    )
    tables = Tables(spark, "ngram")
    rows_before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(BATCH_ROWS, int(rows_before)) if int(rows_before) > 0 else BATCH_ROWS))
    try:
        vertices = tables.keep(counted)
    finally:
        spark.conf.set(_BATCH, rows_before)
    able = vertices.where("size(prefix) > 0")
    # Equal sets of several blocks are one vertex from here on: the least stands for its copies.
    firsts = able.groupBy("digest").agg(F.min("vertex").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    copies = tables.keep(able.select("vertex", "digest").join(firsts, "digest").where("vertex <> first").select("vertex", "first"))
    single = able.join(copies.select("vertex"), "vertex", "left_anti")
    heads = tables.keep(single.select("vertex", "n", "common", F.size(F.flatten("segments")).alias("shared"), "prefix", "held"))
    tasks = enough_tasks(spark, heads.agg(F.sum(F.size("prefix"))).first()[0] or 0)

    # A round compares labels, not documents: ``label`` is the component so far, ``of`` its number of vertices, and
    # ``after`` how many of a document's shared n-grams come no earlier in the order than this one.
    grams = heads.select("vertex", "n", "common", "shared", F.posexplode("prefix").alias("at", "gram"))
    grams = grams.withColumns({"after": F.col("shared") - F.col("at"), "label": F.col("vertex"), "of": F.lit(1).cast("long")})
    labelled = tables.keep(grams.drop("shared", "at").coalesce(tasks))

    # Rounds of centres: each n-gram names documents of its largest component so far, and a document of
    # another component is compared with those that most of its rare n-grams name. An n-gram whose documents
    # are all connected is done, and its rows are left out from then on.
    fits = f"100 * least(nu, nv) >= {percent} * greatest(nu, nv) AND {100 + percent} * least(au, av) >= {percent} * (nu + nv)"
    names = heads.select("vertex", F.col("vertex").alias("label"))
    turn, hits, tried = 0, True, []
    while True:
        centres = CENTRES if turn else 1
        ranked = [
            F.struct(
                (-F.col("of")).alias("of"), F.pmod(F.xxhash64("vertex", F.lit(turn), F.lit(i)), F.lit(PARTS if turn else 1)).alias("h"),
                (-F.col("common")).alias("common"), "vertex", "n", "after", "label",
            )
            for i in range(centres)
        ]
        first = [F.min(c).alias(f"c{i}") for i, c in enumerate(ranked)]
        in_label = labelled.groupBy("gram", "label").agg(F.count("*").alias("own"), *first) if turn else labelled.withColumns(
            {"own": F.lit(1).cast("long"), "c0": ranked[0]}
        )
        ends = in_label.groupBy("gram").agg(
            F.count("*").alias("labels"), F.sum("own").alias("documents"), F.sum(F.col("own") * F.col("own")).alias("inner"),
            F.array(*(F.min(f"c{i}") for i in range(centres))).alias("centres"),
        )
        open_grams = tables.keep(ends.where("labels > 1").drop("labels").coalesce(tasks))
        size = open_grams.agg(F.sum(F.col("documents") * F.col("documents") - F.col("inner")).alias("pairs"), F.sum("documents").alias("rows")).first()
        if (size.pairs or 0) <= PAIRS_A_ROW * (size.rows or 0) or turn > 1 and not hits:
            break
        turn += 1
        weighed = open_grams.select("gram", "centres", F.floor(F.lit(WEIGHT) / F.col("documents")).alias("weight"))
        opened = tables.keep(labelled.join(weighed, "gram").coalesce(tasks))
        votes = opened.select("vertex", "n", "after", "label", "weight", F.explode("centres").alias("c")).select(
            "weight",
            F.col("vertex").alias("u"), F.col("n").alias("nu"), F.col("after").alias("au"), F.col("label").alias("lu"),
            F.col("c.vertex").alias("v"), F.col("c.n").alias("nv"), F.col("c.after").alias("av"), F.col("c.label").alias("lv"),
        ).where("lu <> lv").where(fits)
        # Dealt once by u for weighing, ranking and the join that follows; a document's votes are bounded by its n-grams.
        # The rarer an n-gram, the more it says of who else is similar. No pair is compared twice.
        most = Window.partitionBy("u").orderBy(F.col("weight").desc(), "v")
        counted = votes.select("u", "v", "lu", "lv", "weight").repartition("u").groupBy("u", "v", "lu", "lv").agg(F.sum("weight").alias("weight"))
        for earlier in tried:
            counted = counted.join(earlier, ["u", "v"], "left_anti")
        chosen = tables.keep(counted.withColumn("nth", F.row_number().over(most)).where(F.col("nth") <= centres).drop("weight", "nth").coalesce(tasks))
        tried.append(chosen.select("u", "v"))
        found = tables.keep(_linked(_possible(chosen, heads, percent), able, percent).distinct().coalesce(tasks))
        hits = found.count() > FEW * chosen.count()
        names = tables.keep(_merged(spark, names, found, tasks).coalesce(tasks))
        sized = names.join(names.groupBy("label").agg(F.count("*").alias("of")), "label")
        labelled = tables.keep(opened.drop("centres", "weight", "label", "of").join(sized, "vertex").coalesce(tasks))

    # Then all pairs under a common rare n-gram that are not connected yet. At a similar pair's
    # first common n-gram both sides have enough n-grams left for the overlap it takes.
    # Two sets have no more in common than the less of what each has of a pivot, and the less of what each has beside it.
    open_rows = labelled.join(open_grams.select("gram"), "gram").withColumns({"inside": F.lit(0).cast("long"), "beside": F.col("n")})
    if (size.pairs or 0) > PAIRS_A_ROW * (size.rows or 0):
        open_rows = tables.keep(_with_pivots(open_rows, heads, names, able).coalesce(tasks))
    left, right = (
        open_rows.select("gram", *(F.col(c).alias(f"{a}{x}") for c, a in (("vertex", ""), ("n", "n"), ("after", "a"), ("label", "l"), ("inside", "i"), ("beside", "b"))))
        for x in "uv"
    )
    bound = f"{100 + percent} * (least(iu, iv) + least(bu, bv)) >= {percent} * (nu + nv)"
    pairs = left.join(right, "gram").where("lu < lv").where(fits).where(bound).select("u", "v", "lu", "lv").distinct()
    late = tables.keep(_linked(_possible(pairs, heads, percent), able, percent).distinct().coalesce(tasks))
    final = _merged(spark, names, late, tasks)
    of_copies = copies.join(final.withColumnRenamed("vertex", "first"), "first").select("vertex", "label")
    final = final.select("vertex", "label").union(of_copies)

    named_rows = vertices.join(final, "vertex", "left").select(
        F.coalesce("label", "vertex").alias("component"), "n", "doc_ids"
    )
    least = named_rows.where("n > 0").groupBy("component").agg(F.min(F.array_min("doc_ids")).alias("component_id"))
    rows = named_rows.join(least, "component", "left").select(F.explode("doc_ids").alias("doc_id"), "n", "component_id")
    named_docs = rows.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    result = stored(spark, named_docs, "ngram-components")
    tables.drop()
    return result
