"""Token ids in Simple-8b words: each 64-bit word holds a selector and as many ids as fit.

The top four bits of a word choose how many ids of how many bits fill the other 60. Ids are coded in
frames of ``FRAME`` ids; a frame starts a new word, so the frames' word offsets in a block allow
reading from any of them, and all frames of a block are coded side by side. Ids of more than
``ESCAPE_BITS`` bits are written as 0 and kept apart with their place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import packing, word_ids
from rankloom.plans import scratch

# Fixed values of the coding: ids in a word, and bits of each, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

FRAME = 1024
ESCAPE_BITS = 20
# Words that the encoder remembers, and bytes of a slice of texts; they bound a worker's memory.
REMEMBER, SLICE_BYTES = 400_000, 2 << 20
# A block ends before the document that would bring it beyond so many ids.
BLOCK_IDS = 1 << 17
WIDTHS = np.zeros(1 << ESCAPE_BITS, np.uint8)
for _bit in range(ESCAPE_BITS):
    WIDTHS[1 << _bit :] += 1


class Coded(NamedTuple):
    """One block: words, each frame's first word, and places and values of escaped ids."""

    words: np.ndarray
    frames: np.ndarray
    escape_at: np.ndarray
    escaped: np.ndarray


def encode(ids: np.ndarray) -> Coded:
    """Code any unsigned 32-bit ids; the inverse of ``decode``. Works on a bounded stretch at a time."""
    parts = [encode_stretch(ids[at : at + BLOCK_IDS]) for at in range(0, max(len(ids), 1), BLOCK_IDS)]
    words_before = np.cumsum([0, *(len(p.words) for p in parts[:-1])])
    return Coded(
        np.concatenate([p.words for p in parts]),
        np.concatenate([p.frames + b for p, b in zip(parts, words_before)]).astype(np.uint32),
        np.concatenate([p.escape_at + i * BLOCK_IDS for i, p in enumerate(parts)]).astype(np.uint32),
        np.concatenate([p.escaped for p in parts]),
    )


def encode_stretch(ids: np.ndarray) -> Coded:
    ids = ids.astype(np.uint64)
    wide = np.flatnonzero(ids >> np.uint64(ESCAPE_BITS))
    escaped = ids[wide].astype(np.uint32)
    ids[wide] = 0
    n = len(ids)
    lanes = -(-n // FRAME)
    if not lanes:
        return Coded(np.zeros(0, np.uint64), np.zeros(0, np.uint32), wide.astype(np.uint32), escaped)
    chosen = selectors(ids, lanes)
    # All frames step from word to word together.
    live, starting = np.arange(lanes) * FRAME, np.zeros(lanes * FRAME, bool)
    ends = np.minimum(live + FRAME, n)
    while len(live):
        starting[live] = True
        live = live + COUNTS[chosen[live]]
        inside = live < ends
        live, ends = live[inside], ends[inside]
    starts = np.flatnonzero(starting)
    limits = np.minimum((starts // FRAME + 1) * FRAME, n)
    selector = chosen[starts]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector):
        if BITS[s]:
            own = np.flatnonzero(selector == s)
            packed = words[own]
            for k in range(int(COUNTS[s])):
                place = starts[own] + k
                value = ids[np.minimum(place, n - 1)] << np.uint64(k * int(BITS[s]))
                packed |= np.where(place < limits[own], value, np.uint64(0))
            words[own] = packed
    frames = np.searchsorted(starts, np.arange(lanes) * FRAME).astype(np.uint32)
    return Coded(words, frames, wide.astype(np.uint32), escaped)


def selectors(ids: np.ndarray, lanes: int) -> np.ndarray:
    """For a word that starts at each id: the selector that takes the most of the ids from there on.

    A word may reach beyond its frame or the last id; what lies there counts as fitting.
    """
    widths = np.zeros((lanes, FRAME + COUNTS[0]), np.uint8)
    flat = np.zeros(lanes * FRAME, np.uint8)
    flat[: len(ids)] = WIDTHS[ids.astype(np.uint32)]
    widths[:, :FRAME] = flat.reshape(lanes, FRAME)
    # Widest of the next so many ids; of two overlapping stretches for longer ones.
    widest, reach = widths, 1
    chosen = np.full((lanes, FRAME), 15, np.uint8)
    for s in range(14, -1, -1):
        count = int(COUNTS[s])
        while reach < count:
            step = min(reach, count - reach)
            widest = np.maximum(widest[:, : widest.shape[1] - step], widest[:, step:])
            reach += step
        chosen[widest[:, :FRAME] <= BITS[s]] = s
    return chosen.ravel()


def decode(coded: Coded, n: int) -> np.ndarray:
    """The ``n`` ids of a block, all words of one selector at a time."""
    selector = (coded.words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    # Inside a frame the words follow each other; each frame starts anew.
    lanes = len(coded.frames)
    before = np.cumsum(counts) - counts
    sizes = np.diff(np.append(coded.frames, len(coded.words)))
    lane = np.repeat(np.arange(lanes), sizes)
    starts = before - before[coded.frames][lane] + lane * FRAME if lanes else before
    limit = np.minimum((lane + 1) * FRAME, n)
    ids = np.zeros(n, np.uint32)
    for s in np.unique(selector):
        if not BITS[s]:
            continue
        own = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(int(COUNTS[s])):
            place = starts[own] + k
            inside = place < limit[own]
            ids[place[inside]] = (coded.words[own[inside]] >> np.uint64(k * int(BITS[s]))) & mask
    ids[coded.escape_at] = coded.escaped
    return ids


def block_schema(kind: str) -> str:
    """Columns of a block; ``kind`` is the type of the documents' ids."""
    return (
        f"part long, block long, local_start long, n_tokens long, doc_ids array<{kind}>, doc_tokens array<long>, "
        "words binary, frames binary, escape_at binary, escaped binary"
    )


def encoded_rows(docs: DataFrame, file: str, end_id: int) -> DataFrame:
    """``(doc_id, wide, ids)``: each text's ids, two bytes each or, where a batch has larger ones, four."""

    def made(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, counts in word_ids.encoded(rows, file, end_id, REMEMBER, SLICE_BYTES):
            wide = bool(len(ids)) and int(ids.max()) >= 1 << 16
            kind = "<u4" if wide else "<u2"
            edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64) * np.dtype(kind).itemsize
            blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(edges), pa.py_buffer(ids.astype(kind))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([wide] * len(counts)), blobs.cast(pa.binary())], ["doc_id", "wide", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(made, f"doc_id {kind}, wide boolean, ids binary")


def coded_blocks(docs: DataFrame, file: str, end_id: int) -> DataFrame:
    """Blocks of whole documents in ascending doc_id order; ``part`` ascends with doc_id, too.

    Texts are encoded where they lie and their ids are stored; only ids are then dealt out by ranges
    of doc_id. Rows of one doc_id may lie in several ranges, in the order of a hash of their ids.
    """
    rows, path = encoded_rows(docs, file, end_id), scratch.fresh_path(docs.sparkSession, "ids")
    rows.write.option("compression", "zstd").parquet(path)
    stored = docs.sparkSession.read.schema(rows.schema).parquet(path)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("mixed"), F.col("ids")]
    ordered = stored.withColumn("mixed", F.xxhash64("ids")).repartitionByRange(width, *order[:2]).sortWithinPartitions(*order)

    def flushed(part: int, block: int, before: int, doc_ids: list, kind: pa.DataType, ids: list[np.ndarray]) -> pa.RecordBatch:
        counts = np.array([len(x) for x in ids], np.int64)
        coded = encode(np.concatenate(ids))
        return pa.RecordBatch.from_arrays(
            [
                *(pa.array([x], pa.int64()) for x in (part, block, before, int(counts.sum()))),
                pa.array([doc_ids], pa.list_(kind)),
                pa.array([counts], pa.list_(pa.int64())),
                *(pa.array([x.astype(x.dtype.newbyteorder("<")).tobytes()], pa.binary()) for x in coded),
            ],
            ["part", "block", "local_start", "n_tokens", "doc_ids", "doc_tokens", "words", "frames", "escape_at", "escaped"],
        )

    def made(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker that has encoded texts before need not keep the encoder's words.
        word_ids.encoder.cache_clear()
        part, block, before = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        ids: list[np.ndarray] = []
        size, kind = 0, pa.int64()
        for batch in rows:
            kind = batch.column("doc_id").type
            wide = batch.column("wide").to_pylist()
            for doc_id, is_wide, blob in zip(batch.column("doc_id").to_pylist(), wide, batch.column("ids")):
                found = np.frombuffer(blob.as_buffer(), "<u4" if is_wide else "<u2").astype(np.uint32)
                if ids and size + len(found) > BLOCK_IDS:
                    yield flushed(part, block, before, doc_ids, kind, ids)
                    block, before, size, doc_ids, ids = block + 1, before + size, 0, [], []
                doc_ids.append(doc_id)
                ids.append(found)
                size += len(found)
        if ids:
            yield flushed(part, block, before, doc_ids, kind, ids)

    return ordered.select("doc_id", "wide", "ids").mapInArrow(made, block_schema(docs.schema["doc_id"].dataType.simpleString()))


def write_ids(docs: DataFrame, path: str, file: str, end_id: int) -> None:
    """Write the ids of ``docs(doc_id, text)`` with ``end_id`` behind each text, in doc_id order.

    Parquet files of blocks (:func:`block_schema`). Ids of documents may have any type with an order.
    A null text counts as empty; null ids come first; repeated rows are written once each; an empty
    table gives files without blocks.
    """
    coded_blocks(docs, file, end_id).write.parquet(path)


def read_ids(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from written files; ids as little-endian unsigned 32-bit.

    ``kind`` is the type of the documents' ids.
    """
    blocks = spark.read.schema(block_schema(kind)).parquet(path)
    placed = blocks.join(F.broadcast(packing.partition_starts(blocks)), "part").withColumn(
        "at", F.col("base") + F.col("local_start")
    )

    def opened(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids.encoder.cache_clear()
        for batch in rows:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                kinds = zip(("words", "frames", "escape_at", "escaped"), ("<u8", "<u4", "<u4", "<u4"))
                coded = Coded(*(np.frombuffer(row[name].as_buffer(), kind) for name, kind in kinds))
                ids = decode(coded, row["n_tokens"].as_py())
                counts = row["doc_tokens"].values.to_numpy()
                starts = row["at"].as_py() + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(starts), pa.array(counts), packing.id_blobs(ids, counts).cast(pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    columns = ("at", "n_tokens", "doc_ids", "doc_tokens", "words", "frames", "escape_at", "escaped")
    return placed.select(*columns).mapInArrow(opened, f"doc_id {kind}, start long, n_tokens long, ids binary")


def checksums(read: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of rows from ``read_ids``."""

    def summed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            crcs = [zlib.crc32(x.as_buffer()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    kind = read.schema["doc_id"].dataType.simpleString()
    return read.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        summed, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long"
    )
