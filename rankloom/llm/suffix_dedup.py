"""Removal of byte strings of a fixed length that stand in a document of smaller id, too.

Every window of ``WINDOW`` bytes has an anchor: of its positions the one whose next ``ANCHOR`` bytes
hash lowest, the leftmost on ties. Equal windows have equal anchors at the same offset, so windows
meet by their anchors, about one for fourteen bytes of text:

1. texts are dealt to blocks by id, once; a block sends its anchors' hashes to buckets;
2. buckets send back the hashes that stand in two documents or more;
3. blocks send the stretches of text around these anchors, equal ones of a block as one;
4. buckets sort the suffixes right of the anchors, and the reversed ones left of them, by
   deep-shallow sorting. Windows are equal where both sides lie within the same run of common
   prefixes; each learns the smallest document that holds it;
5. blocks remove what stands in a smaller document.

Exact copies of whole texts are set aside first, by their SHA-256. What a bucket gets of a frequent
passage is bounded by the number of blocks, not of documents.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm import batches, deep_shallow, shingles
from rankloom.plans import joins, scratch

WINDOW = 50
ANCHOR = 24
LEFT = WINDOW - ANCHOR
SHALLOW_RIGHT, SHALLOW_LEFT = 32, 8
# Text of a block; larger blocks make fewer and longer messages on larger corpora.
BLOCK_BYTES = 16 << 20
SLICE_BYTES = 2 << 20
# Copies that may be broadcast, at about eighty bytes each.
BROADCAST_COPIES = 500_000
FACTORS = batches.mix(np.arange(1, ANCHOR // 8 + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)
HIGH = np.uint64(0xFFFFFFFF00000000)
LOW = np.uint64(0xFFFFFFFF)


class Runs(NamedTuple):
    """Windows that follow each other and share an anchor: first and last start, anchor, code."""

    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    code: np.ndarray  # bucket in the upper, hash in the lower half


def anchored(data: np.ndarray, offsets: np.ndarray, buckets: int) -> Runs:
    """All windows of all texts as runs; positions count from the start of ``data``."""
    n = len(data)
    sizes = np.diff(offsets)
    windows = np.maximum(sizes - WINDOW + 1, 0)
    if not windows.any():
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none.astype(np.uint64))
    padded = np.concatenate([data, np.zeros(ANCHOR + 8, np.uint8)])
    eight = np.ndarray((n + ANCHOR,), "<u8", padded.data, strides=(1,))
    hashed = np.zeros(n, np.uint64)
    for i, factor in enumerate(FACTORS):
        hashed += eight[8 * i : 8 * i + n] * factor
    hashed = batches.mix(hashed)
    # Smallest hash and leftmost place in one number; then minima over 2, 4, ... and all places.
    low = hashed & HIGH | np.arange(n, dtype=np.uint64)
    reach, span = 1, LEFT + 1
    while 2 * reach <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if span > reach:
        low = np.minimum(low[: len(low) - (span - reach)], low[span - reach :])
    starts = batches.gather(offsets[:-1], windows)
    places = (low[starts] & LOW).astype(np.int64)
    edge = np.append(True, places[1:] != places[:-1])
    first = starts[edge]
    last = starts[np.append(edge[1:], True)]
    anchor = places[edge]
    spread = batches.mix(hashed[anchor] + np.uint64(1))
    code = (spread >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | spread & LOW
    return Runs(np.searchsorted(offsets, first, side="right") - 1, first, last, anchor, code)


def block_slices(table: pa.Table):
    """Slices of a block's rows: ids, bytes and offsets. A long text is a slice of its own."""
    for part in batches.slices(iter(table.combine_chunks().to_batches()), limit=SLICE_BYTES):
        yield part.column("doc_id").to_numpy(), *batches.bytes_and_offsets(batches.text_of(part))


def pieces(data: np.ndarray, offsets: np.ndarray):
    """A slice as it is; one long text in pieces that hold each of its windows once, and their places."""
    if len(offsets) != 2 or len(data) <= SLICE_BYTES:
        yield 0, data, offsets
        return
    for start in range(0, len(data) - WINDOW + 1, SLICE_BYTES):
        piece = data[start : start + SLICE_BYTES + WINDOW - 1]
        yield start, piece, np.array([0, len(piece)])


def context_hashes(data: np.ndarray, runs: Runs) -> np.ndarray:
    """Hashes of the text that a run's windows cover, with the anchor's place in it."""
    found = shingles.range_hashes(data, runs.first, runs.last + WINDOW)
    return batches.mix(found + (runs.anchor - runs.first).astype(np.uint64) * shingles.BASE)


def chosen(runs: Runs, codes: np.ndarray) -> Runs:
    """Runs whose code is among the sorted ``codes``."""
    if not len(codes):
        return Runs(*(x[:0] for x in runs))
    at = np.minimum(np.searchsorted(codes, runs.code), len(codes) - 1)
    own = codes[at] == runs.code
    return Runs(*(x[own] for x in runs))


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order of ``keys`` and the starts of equal ones in it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    return order, np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, np.int64)


def messages(codes: np.ndarray, columns: dict[str, np.ndarray], fixed: dict[str, int], key: str) -> pa.Table:
    """One row for each bucket in the sorted ``codes``; columns as bytes."""
    bucket = (codes >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(codes) else np.zeros(0, np.int64)
    edges = np.append(starts, len(codes))
    out: dict[str, pa.Array] = {key: pa.array(bucket[starts])}
    out |= {name: pa.array(np.full(len(starts), value, np.int64)) for name, value in fixed.items()}
    for name, values in columns.items():
        whole = values.tobytes()
        size = len(whole) // max(len(codes), 1)
        out[name] = pa.array([whole[a * size : b * size] for a, b in zip(edges[:-1], edges[1:])], pa.binary())
    return pa.table(out)


def read(table: pa.Table, name: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in table[name].combine_chunks()]


HASHES = "bucket long, block long, hashes binary, several binary"
COMMON = "block long, bucket long, hashes binary"
CONTEXTS = "bucket long, block long, hashes binary, contexts binary, shapes binary, docs binary, texts binary"
FINDINGS = "block long, hashes binary, contexts binary, spans binary, docs binary"


def send_hashes(buckets: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        codes, least, most = [], [], []
        for ids, data, offsets in ((i, d, o) for i, *whole in block_slices(table) for _, d, o in pieces(*whole)):
            runs = anchored(data, offsets, buckets)
            order, starts = grouped(runs.code)
            if len(starts):
                docs = ids[runs.doc[order]]
                codes.append(runs.code[order][starts])
                least.append(np.minimum.reduceat(docs, starts))
                most.append(np.maximum.reduceat(docs, starts))
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order, starts = grouped(code)
        several = np.zeros(0, np.uint8)
        if len(starts):
            low = np.minimum.reduceat(np.concatenate(least)[order], starts)
            high = np.maximum.reduceat(np.concatenate(most)[order], starts)
            several = (low < high).astype(np.uint8)
        code = code[order][starts]
        return messages(code, {"hashes": (code & LOW).astype("<u4"), "several": several}, {"block": key[0].as_py()}, "bucket").select(
            ["bucket", "block", "hashes", "several"]
        )

    return send


def find_common(key: tuple, table: pa.Table) -> pa.Table:
    """Hashes that two blocks have, or one block in two documents; back to the blocks that have them."""
    hashes = read(table, "hashes", "<u4")
    several = np.concatenate(read(table, "several", "u1")).astype(bool)
    order, starts = grouped(np.concatenate(hashes))
    counts = np.diff(np.append(starts, len(order)))
    common = (counts > 1) | np.maximum.reduceat(several[order], starts)
    wanted = np.empty(len(order), bool)
    wanted[order] = np.repeat(common, counts)
    blocks = table["block"].to_pylist()
    edges = np.cumsum([0, *map(len, hashes)])
    rows = [(b, h[wanted[s:e]].tobytes()) for b, h, s, e in zip(blocks, hashes, edges[:-1], edges[1:])]
    rows = [r for r in rows if r[1]]
    return pa.table(
        {
            "block": pa.array([r[0] for r in rows], pa.int64()),
            "bucket": pa.array([key[0].as_py()] * len(rows), pa.int64()),
            "hashes": pa.array([r[1] for r in rows], pa.binary()),
        }
    )


def send_contexts(buckets: int):
    def send(key: tuple, table: pa.Table, common: pa.Table) -> pa.Table:
        wanted = [
            np.uint64(bucket) << np.uint64(32) | h.astype(np.uint64) for bucket, h in zip(common["bucket"].to_pylist(), read(common, "hashes", "<u4"))
        ]
        codes = np.sort(np.concatenate(wanted)) if wanted else np.zeros(0, np.uint64)
        parts: list[tuple] = []
        for ids, data, offsets in ((i, d, o) for i, *whole in block_slices(table) for _, d, o in pieces(*whole)):
            runs = chosen(anchored(data, offsets, buckets), codes)
            if not len(runs.code):
                continue
            context = context_hashes(data, runs)
            order, starts = grouped(batches.mix(runs.code) + context)
            docs = ids[runs.doc[order]]
            one = order[starts]
            sizes = runs.last[one] + WINDOW - runs.first[one]
            text = np.zeros((len(one), LEFT + WINDOW), np.uint8)
            at = batches.gather(np.arange(len(one)) * text.shape[1], sizes)
            text.ravel()[at] = data[batches.gather(runs.first[one], sizes)]
            shape = np.column_stack([runs.anchor[one] - runs.first[one], sizes]).astype(np.uint8)
            parts.append((runs.code[one], context[one], shape, np.minimum.reduceat(docs, starts), np.maximum.reduceat(docs, starts), text))
        if not parts:
            return messages(np.zeros(0, np.uint64), dict.fromkeys(("hashes", "contexts", "shapes", "docs", "texts"), np.zeros(0)), {"block": 0}, "bucket")
        code, context, shape, least, most, text = (np.concatenate(x) for x in zip(*parts))
        # Slices of the block may hold the same stretch.
        order, starts = grouped(batches.mix(code) + context)
        least, most = np.minimum.reduceat(least[order], starts), np.maximum.reduceat(most[order], starts)
        code, context, shape, text = (x[order[starts]] for x in (code, context, shape, text))
        order = np.argsort(code, kind="stable")
        code = code[order]
        rest = {
            "hashes": (code & LOW).astype("<u4"),
            "contexts": context[order].astype("<u8"),
            "shapes": shape[order],
            "docs": np.column_stack([least, most])[order].astype("<i8"),
            "texts": text[order],
        }
        return messages(code, rest, {"block": key[0].as_py()}, "bucket")

    return send


def smallest_holders(key: tuple, table: pa.Table) -> pa.Table:
    """For every window of every stretch the smallest document that holds it, where that matters.

    A window is told by its bytes right of the anchor's start and those left of it. In the order of
    the sorted suffixes, equal ones of one length are the runs whose common prefixes reach it.
    """
    hashes = read(table, "hashes", "<u4")
    of = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    anchor_hash = np.concatenate(hashes)
    context = np.concatenate(read(table, "contexts", "<u8"))
    shape = np.concatenate(read(table, "shapes", "u1")).reshape(-1, 2).astype(np.int64)
    docs = np.concatenate(read(table, "docs", "<i8")).reshape(-1, 2)
    text = np.concatenate(read(table, "texts", "u1")).reshape(-1, LEFT + WINDOW)
    n = len(of)
    left, size = shape[:, 0], shape[:, 1]
    column = np.arange(WINDOW)
    inside = column < (size - left)[:, None]
    right_text = np.where(inside, np.take_along_axis(text, np.minimum(left[:, None] + column, LEFT + WINDOW - 1), axis=1), 0)
    column = np.arange(LEFT)
    left_text = np.where(column < left[:, None], np.take_along_axis(text, np.maximum(left[:, None] - 1 - column, 0), axis=1), 0)
    right_order, right_common = deep_shallow.sort(right_text, SHALLOW_RIGHT)
    left_order, left_common = deep_shallow.sort(left_text, SHALLOW_LEFT)
    never = np.iinfo(np.int64).max
    holder = np.full((n, LEFT + 1), never)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    least_left = left - (size - WINDOW)  # the anchor's place in the last window
    for offset in range(LEFT + 1):
        own = np.flatnonzero((least_left <= offset) & (offset <= left))
        if not len(own):
            continue
        right_class[right_order] = np.cumsum(right_common < WINDOW - offset)
        left_class[left_order] = np.cumsum(left_common < offset)
        order, starts = grouped(right_class[own] * (n + 1) + left_class[own])
        least = np.minimum.reduceat(docs[own[order], 0], starts)
        holder[own[order], offset] = np.repeat(least, np.diff(np.append(starts, len(order))))
    holder[holder >= docs[:, 1:2]] = never  # no document of the block has anything to remove
    # Neighbouring windows with the same holder become one finding.
    change = np.ones((n, LEFT + 2), bool)
    change[:, 1:-1] = holder[:, 1:] != holder[:, :-1]
    row, low = np.nonzero(change[:, :-1] & (holder != never))
    following = np.nonzero(change.ravel())[0]
    high = following[np.searchsorted(following, row * (LEFT + 2) + low, side="right")] - row * (LEFT + 2) - 1
    blocks = table["block"].to_numpy()
    edges = np.searchsorted(of[row], np.arange(len(blocks) + 1))
    out: dict[str, list] = {"block": [], "hashes": [], "contexts": [], "spans": [], "docs": []}
    bucket = np.uint64(key[0].as_py()) << np.uint64(32)
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        if a < b:
            r = row[a:b]
            out["block"].append(blocks[i])
            out["hashes"].append((bucket | anchor_hash[r].astype(np.uint64)).astype("<u8").tobytes())
            out["contexts"].append(context[r].astype("<u8").tobytes())
            out["spans"].append(np.column_stack([low[a:b], high[a:b]]).astype(np.uint8).tobytes())
            out["docs"].append(holder[r, low[a:b]].astype("<i8").tobytes())
    kinds = [pa.int64(), *[pa.binary()] * 4]
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})


def remove(buckets: int):
    def removed(key: tuple, table: pa.Table, findings: pa.Table) -> pa.Table:
        def whole(name: str, kind: str) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *read(findings, name, kind)])

        code, context, holder = whole("hashes", "<u8"), whole("contexts", "<u8"), whole("docs", "<i8")
        spans = whole("spans", "u1").reshape(-1, 2).astype(np.int64)
        codes = np.unique(code)
        told = batches.mix(code) + context
        order = np.argsort(told, kind="stable")
        told, spans, holder = told[order], spans[order], holder[order]
        out: dict[str, list] = {"doc_id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for ids, data, offsets in block_slices(table):
            cover = np.zeros(len(data) + 1, np.int32)
            for place, piece, edges in pieces(data, offsets) if len(codes) else ():
                runs = chosen(anchored(piece, edges, buckets), codes)
                wanted = batches.mix(runs.code) + context_hashes(piece, runs)
                a, b = np.searchsorted(told, wanted), np.searchsorted(told, wanted, side="right")
                pick = np.repeat(np.arange(len(wanted)), b - a)
                found = batches.gather(a, b - a)
                own = ids[runs.doc[pick]] > holder[found]
                pick, found = pick[own], found[own]
                anchor = place + runs.anchor[pick]
                np.add.at(cover, anchor - spans[found, 1], 1)
                np.add.at(cover, anchor - spans[found, 0] + WINDOW, -1)
            gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
            out["doc_id"] += ids.tolist()
            for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                mask = gone[start:end]
                many = int(np.count_nonzero(mask))
                out["n_bytes"].append(end - start)
                out["n_removed"].append(many)
                out["n_spans"].append(int(np.count_nonzero(mask[1:] & ~mask[:-1]) + mask[0]) if many else 0)
                kept = data[start:end][~mask] if many else data[start:end]
                out["kept_sha256"].append(hashlib.sha256(kept.tobytes()).hexdigest())
        kinds = [*[pa.int64()] * 4, pa.string()]
        return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})

    return removed


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row of ``docs(doc_id, text)``.

    Each byte goes that a ``WINDOW``-byte string covers which also starts in a document of smaller
    doc_id; strings are judged on the input, and matches lie inside documents. A null text counts as
    empty; texts shorter than the window lose nothing; rows of equal doc_id do not take from each
    other; rows without a doc_id keep their text and take from none.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    marked = texts.withColumn("sha", F.sha2("text", 256)).withColumn("n", F.octet_length("text").cast("long"))
    marks = scratch.materialise(marked.select("doc_id", "sha", "n"), "repeats-marks")
    firsts = marks.groupBy("sha").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    copies = scratch.materialise(
        marks.join(scratch.materialise(firsts.select("sha", "least"), "repeats-firsts"), "sha").where("doc_id > least").select("doc_id", "sha", "n"), "repeats-copies"
    )
    distinct = copies.select("doc_id", "sha").distinct()
    few = joins.fits(copies.count(), BROADCAST_COPIES)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = marks.agg(F.sum("n")).first()[0] or 0
    blocks = max(width, -(-total // block_bytes))
    own = (
        marked.where("doc_id IS NOT NULL")
        .join(joins.broadcast_if(distinct, few), ["doc_id", "sha"], "left_anti")
        .select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"))
    )
    sent = own.groupBy("block").applyInArrow(send_hashes(blocks), HASHES)
    common = sent.groupBy("bucket").applyInArrow(find_common, COMMON)
    stretches = own.groupBy("block").cogroup(common.groupBy("block")).applyInArrow(send_contexts(blocks), CONTEXTS)
    found = stretches.groupBy("bucket").applyInArrow(smallest_holders, FINDINGS)
    result = own.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(remove(blocks), RESULT)
    gone = F.col("n") >= WINDOW
    copied = copies.select(
        "doc_id", F.col("n").alias("n_bytes"), F.when(gone, F.col("n")).otherwise(0).alias("n_removed"), gone.cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
    )
    nameless = marks.where("doc_id IS NULL").select(
        "doc_id", F.col("n").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256")
    )
    return result.union(copied).union(nameless)
