"""Concatenate and cut: all documents as one row of tokens, cut into windows of a fixed length.

Two passes. The first encodes each partition's texts once and stores the ids with their place inside
the partition. Prefix sums over the partitions' totals give each partition its place in the whole;
the second pass cuts the stored ids at the windows' edges.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm import word_ids
from rankloom.plans import scratch


def id_blobs(ids: np.ndarray, counts: np.ndarray) -> pa.LargeBinaryArray:
    """One binary value per document: its ids as little-endian unsigned 32-bit integers."""
    edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * 4
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(edges), pa.py_buffer(ids.astype("<u4"))])


def tokenised(docs: DataFrame, file: str, end_id: int) -> DataFrame:
    """``(doc_id, part, local_start, n_tokens, ids)``: ids with ``end_id``, placed within partitions.

    ``part`` and ``local_start`` hold for one run of the tasks only: store the result before use.
    """

    def made(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch, ids, counts in word_ids.encoded(rows, file, end_id):
            starts = before + np.cumsum(counts) - counts
            before = int(starts[-1] + counts[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(counts), part, np.int64)), pa.array(starts), pa.array(counts), id_blobs(ids, counts).cast(pa.binary())],
                ["doc_id", "part", "local_start", "n_tokens", "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        made, f"doc_id {kind}, part long, local_start long, n_tokens long, ids binary"
    )


def partition_starts(stored: DataFrame) -> DataFrame:
    """``(part, base)``: tokens of all partitions before this one. One row per partition, so always small."""
    totals = stored.groupBy("part").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))


def pack(docs: DataFrame, file: str, end_id: int, length: int = 4096) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens; only the last one can be short.

    Returns ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row for each
    part of a document between two edges: the boundary records. A null or empty text is its end
    token alone; repeated rows are packed once each; an empty table gives no rows. ``file`` is a
    tokenizers file that executors can read.
    """
    stored = scratch.materialise(tokenised(docs, file, end_id), "tokens")
    placed = stored.join(F.broadcast(partition_starts(stored)), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("at"), "n_tokens", "ids"
    )

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = batch.column("at").to_numpy()
            n = batch.column("n_tokens").to_numpy()
            pieces = (at + n - 1) // length - at // length + 1
            of = np.repeat(np.arange(len(at)), pieces)
            order = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begins = np.maximum(at[of], (at[of] // length + order) * length)
            ends = np.minimum(at[of] + n[of], (at[of] // length + order + 1) * length)
            starts = begins - at[of]
            blobs = batch.column("ids")
            held, crcs = -1, np.empty(len(of), np.int64)
            for i, (doc, start, size) in enumerate(zip(of.tolist(), starts.tolist(), (ends - begins).tolist())):
                if doc != held:
                    held, blob = doc, memoryview(blobs[doc].as_buffer())
                crcs[i] = zlib.crc32(blob[4 * start : 4 * (start + size)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(of)), *map(pa.array, (starts, ends - begins, crcs, n[of], begins // length, begins % length))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(
        cut,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
