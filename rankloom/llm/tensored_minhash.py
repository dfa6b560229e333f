"""Near-duplicates by tensored banding: table keys are pairs from two small collections of sketches.

A document has two collections of ``m`` sketches, each of ``r`` minimum hashes. Every pair of one
sketch from either collection is a table key: ``m * m`` tables of ``2 * r`` minimum hashes from
``2 * m * r`` of them instead of ``2 * m * m * r``. Two sets of similarity s miss each other with
probability at most 2 * (1 - s^r)^m. Documents that share a key with others form a block; inside a
block every pair is decided on full sets, in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm import batches, components, shingles
from rankloom.plans import joins, scratch

SKETCHES, ROWS = 9, 2
SEEDS = batches.mix(np.arange(1, 2 * SKETCHES * ROWS + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
# Blocks of up to so many documents and shingles are decided in one piece; larger ones are cut.
PIECE_DOCS = 256
PIECE_SHINGLES = 400_000
# Members of blocks that may be broadcast, at sixteen bytes each.
BROADCAST_MEMBERS = 1_000_000


def sketches(sets: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """``2 * SKETCHES`` sketches of each set, the first collection first. Sets must not be empty."""
    lows = np.empty((len(edges) - 1, len(SEEDS)), np.uint64)
    for k, seed in enumerate(SEEDS):
        lows[:, k] = np.minimum.reduceat((sets ^ seed) * (seed | np.uint64(1)), edges[:-1])
    joined = lows[:, 0::ROWS].copy()
    for i in range(1, ROWS):
        joined = batches.mix(joined) + lows[:, i::ROWS]
    return batches.mix(joined).view(np.int64)


def list_column(rows: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(rows.ravel()))


def described(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, n, f, g, first, second)``: set size, 128-bit fingerprint, the two collections."""

    def made(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(rows):
            sets, edges = shingles.sets(*batches.bytes_and_offsets(batches.text_of(part)), width)
            sizes = np.diff(edges)
            some = np.flatnonzero(sizes)
            f, g = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            marks = np.zeros((len(some), 2 * SKETCHES), np.int64)
            if len(some):
                at = edges[some]
                f[some] = np.add.reduceat(batches.mix(sets), at).view(np.int64)
                g[some] = np.bitwise_xor.reduceat(batches.mix(sets + shingles.BASE), at).view(np.int64)
                marks = sketches(sets, np.append(at, edges[-1]))
            counts = np.where(sizes > 0, SKETCHES, 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), pa.array(f), pa.array(g), list_column(marks[:, :SKETCHES], counts), list_column(marks[:, SKETCHES:], counts)],
                ["doc_id", "n", "f", "g", "first", "second"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        made, "doc_id long, n long, f long, g long, first array<long>, second array<long>"
    )


def keyed(classes: DataFrame) -> DataFrame:
    """``(v, key)``: every pair of a sketch of the first and one of the second collection."""
    pairs = F.flatten(F.transform("first", lambda x: F.transform("second", lambda y: F.xxhash64(x, y))))
    return classes.select("v", F.explode(pairs).alias("key"))


def links(sets: list[np.ndarray], percent: int, apart: int = 0) -> list[tuple[int, int]]:
    """Pairs of sets with 100 * intersection >= percent * union; all pairs, or those across ``apart``.

    Of the links found, a forest that connects the same sets.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    if n == 2:
        common = np.array([[0, len(np.intersect1d(sets[0], sets[1], assume_unique=True))], [0, 0]], np.float64)
    else:
        found, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        of = np.repeat(np.arange(n), sizes)
        shared = counts[inverse] > 1
        column = (np.cumsum(counts > 1) - 1)[inverse[shared]]
        of = of[shared]
        common = np.zeros((n, n), np.float64)
        order = np.argsort(column, kind="stable")
        column, of = column[order], of[order]
        step = 2048
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            a, b = np.searchsorted(column, [start, start + step])
            part = np.zeros((n, step), np.float32)
            part[of[a:b], column[a:b] - start] = 1
            if apart:
                common[:apart, apart:] += part[:apart] @ part[apart:].T
            else:
                common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = np.triu(100 * common >= percent * union, 1)
    if apart:
        linked[apart:] = False
        linked[:, :apart] = False
    root = list(range(n))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    forest = []
    for i, j in zip(*np.nonzero(linked)):
        a, b = top(int(i)), top(int(j))
        if a != b:
            root[max(a, b)] = min(a, b)
            forest.append((int(i), int(j)))
    return forest


def set_rows(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """``(v, block, docs, shingles, n, set)`` of the documents in blocks; the set as bytes."""
    few = joins.fits(members.count(), BROADCAST_MEMBERS)
    held = docs.select(F.col("doc_id").cast("long").alias("v"), "text").join(joins.broadcast_if(members, few), "v")

    def made(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(rows):
            sets, edges = shingles.sets(*batches.bytes_and_offsets(batches.text_of(part)), width)
            blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(edges * 8), pa.py_buffer(sets)])
            yield pa.RecordBatch.from_arrays([part.column("v"), part.column("block"), part.column("pieces"), blobs.cast(pa.binary())], ["v", "block", "pieces", "set"])

    return held.select("v", "block", "pieces", "text").mapInArrow(made, "v long, block long, pieces int, set binary").where(F.length("set") > 0)


def verified(rows: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: links that connect what is similar inside each block.

    A block of one piece is decided as it is. A larger one is cut into pieces, and each pair of
    pieces is decided by itself; a set goes to as many tasks as its block has pieces.
    """
    whole = rows.where("pieces = 1").select("v", "set", "block", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"))
    own = F.pmod(F.xxhash64("v"), F.col("pieces")).cast("int")
    cut = (
        rows.where("pieces > 1")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select("v", "set", "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    )
    # Small blocks share a task call; a pair of pieces has one of its own.
    width = 16 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = whole.union(cut).withColumn("deal", F.when(F.col("j") == 0, F.pmod(F.xxhash64("block"), F.lit(width))).otherwise(F.xxhash64("block", "i", "j")))

    def decide(table: pa.Table) -> pa.Table:
        v = table["v"].to_numpy()
        keys = np.stack([table[c].to_numpy() for c in ("block", "i", "j", "side")])
        order = np.lexsort((v, *keys[::-1]))
        unit = np.append(np.flatnonzero(np.append(True, (np.diff(keys[:3, order]) != 0).any(axis=0))), len(order))
        blobs = table["set"].combine_chunks()
        a, b = [], []
        for start, end in zip(unit[:-1], unit[1:]):
            rows = order[start:end]
            if len(rows) > 1:
                sets = [np.frombuffer(blobs[int(r)].as_buffer(), np.uint64) for r in rows]
                for x, y in links(sets, percent, int((keys[3, rows] == 0).sum()) if keys[1, rows[0]] != keys[2, rows[0]] else 0):
                    a.append(v[rows[x]])
                    b.append(v[rows[y]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("deal").applyInArrow(decide, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    Documents whose sets of ``width``-word shingles have ``100 * intersection >= percent * union``
    are linked; a component is named by its smallest doc_id, and that document is kept. Null, empty
    and wordless texts are linked with nothing. Rows of one doc_id count as linked. Rows without a
    doc_id are kept and have no component. Very long texts are compared whole.
    """
    rows = scratch.materialise(described(docs, width), "near-described")
    some = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = scratch.materialise(
        some.groupBy("f", "g", "n").agg(F.min("doc_id").alias("v"), F.first("first").alias("first"), F.first("second").alias("second")), "near-classes"
    )
    centres = scratch.materialise(
        keyed(classes).groupBy("key").agg(F.min("v").alias("centre"), F.count("*").alias("many")).where("many > 1").drop("many"), "near-keys"
    )
    stars = keyed(classes).join(centres, "key").where("v <> centre").select(F.col("v").alias("a"), F.col("centre").alias("b"))
    blocks = components.components(stars.distinct()).withColumnRenamed("root", "block")
    sized = blocks.join(classes.select("v", "n"), "v")
    pieces = sized.groupBy("block").agg(
        F.greatest(F.ceil(F.count("*") / PIECE_DOCS), F.ceil(F.sum("n") / PIECE_SHINGLES)).cast("int").alias("pieces")
    )
    members = scratch.materialise(blocks.join(pieces, "block").select("v", "block", "pieces").distinct(), "near-members")
    similar = verified(set_rows(docs, members, width), percent)
    named = some.join(classes.select("f", "g", "n", "v"), ["f", "g", "n"]).select("doc_id", "v")
    repeated = named.groupBy("doc_id").agg(F.min("v").alias("a"), F.max("v").alias("b")).where("a <> b").select("doc_id", "a")
    same = named.join(repeated, "doc_id").select("a", F.col("v").alias("b"))
    roots = components.components(similar.union(same))
    of_class = classes.select("f", "g", "n", "v").join(roots, "v", "left").select("f", "g", "n", F.coalesce("root", "v").alias("root"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return rows.select("doc_id", "n", "f", "g").join(of_class, ["f", "g", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept")
    )
