"""A byte-level convolutional network in numpy that gives each whole text a probability.

Bytes are embedded, and filters of ``WIDTH`` bytes run over the text in steps of ``STEP``. Chunks of
``CHUNK`` filter positions, each overlapping the next, cover the whole text; a chunk is max-pooled
by filter, the chunks' pooled values are averaged, and a linear layer with a sigmoid makes one
probability of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm import batches, labelled

STEP = 4
WIDTH = 2 * STEP
EMBEDDED = 8
FILTERS = 32
# Filter positions in a chunk, and from one chunk to the next: 512 bytes every 448.
CHUNK, HOP = 127, 112
SLICE_BYTES = 1 << 19

# Bounds of the training sample.
TRAIN_ROWS = 6000
TRAIN_BYTES = 32 << 20


class Weights(NamedTuple):
    """About twenty kilobytes, whatever the corpus."""

    embedding: np.ndarray  # 256 x EMBEDDED
    first: np.ndarray  # STEP * EMBEDDED x FILTERS, for the first STEP bytes of a filter
    second: np.ndarray  # the same for the others
    bias: np.ndarray  # FILTERS
    out: np.ndarray  # FILTERS
    offset: np.ndarray  # 1


class Layout(NamedTuple):
    """Texts padded with zero bytes to whole steps, and where their filters and chunks lie."""

    padded: np.ndarray
    chunk_starts: np.ndarray
    chunk_ends: np.ndarray
    first_chunk: np.ndarray


def layout(data: np.ndarray, offsets: np.ndarray) -> Layout:
    sizes = np.diff(offsets)
    positions = np.maximum(-(-(sizes - WIDTH) // STEP), 0) + 1
    groups = positions + 1
    group_ends = np.cumsum(groups)
    padded = np.zeros(int(group_ends[-1]) * STEP, np.uint8)
    padded[batches.gather((group_ends - groups) * STEP, sizes)] = data
    chunks = np.maximum(-(-(positions - CHUNK) // HOP), 0) + 1
    first_chunk = np.cumsum(chunks) - chunks
    order = batches.gather(np.zeros_like(chunks), chunks)
    begins = np.repeat(group_ends - groups, chunks)
    starts = begins + order * HOP
    ends = np.minimum(starts + CHUNK, begins + np.repeat(positions, chunks))
    return Layout(padded, starts, ends, first_chunk)


def responses(w: Weights, padded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedded steps, and every filter at every position; a position between two texts is unused."""
    steps = w.embedding[padded].reshape(-1, STEP * EMBEDDED)
    both = steps @ np.hstack([w.first, w.second])
    found = both[:, :FILTERS].copy()
    found[:-1] += both[1:, FILTERS:]
    return steps, found


def chunk_sums(w: Weights, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the chunks' pooled values, and the number of chunks, of each text."""
    at = layout(data, offsets)
    _, found = responses(w, at.padded)
    edges = np.stack([at.chunk_starts, at.chunk_ends], axis=1).ravel()
    pooled = np.maximum(np.maximum.reduceat(found, edges, axis=0)[::2] + w.bias, 0)
    counts = np.diff(np.append(at.first_chunk, len(pooled)))[:, None]
    return np.add.reduceat(pooled, at.first_chunk, axis=0), counts


def long_chunk_sums(w: Weights, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``chunk_sums`` for one long text, a bounded stretch of whole chunks at a time."""
    positions = -(-(len(data) - WIDTH) // STEP) + 1
    chunks = -(-(positions - CHUNK) // HOP) + 1
    step = SLICE_BYTES // (HOP * STEP)
    sums = []
    for first in range(0, chunks, step):
        last = min(first + step, chunks)
        end = min((last - 1) * HOP + CHUNK, positions)
        part = data[first * HOP * STEP : (end - 1) * STEP + WIDTH]
        sums.append(chunk_sums(w, part, np.array([0, len(part)]))[0])
    return np.sum(sums, axis=0), np.array([[chunks]])


def probabilities(w: Weights, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One probability for each text. An empty text is a chunk of padding."""
    if len(offsets) < 2:
        return np.zeros(0)
    alone = len(offsets) == 2 and len(data) > SLICE_BYTES
    sums, counts = long_chunk_sums(w, data) if alone else chunk_sums(w, data, offsets)
    means = sums / counts
    logits = (means @ w.out + w.offset[0]).astype(np.float64)
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def start(seed: int = 7) -> Weights:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    side = STEP * EMBEDDED
    return Weights(
        normal(256, EMBEDDED, scale=0.5),
        normal(side, FILTERS, scale=side**-0.5),
        normal(side, FILTERS, scale=side**-0.5),
        np.zeros(FILTERS, np.float32),
        normal(FILTERS, scale=FILTERS**-0.5),
        np.zeros(1, np.float32),
    )


def gradients(w: Weights, data: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> Weights:
    """Gradient of the mean cross entropy; of a maximum, only its place gets a share."""
    at = layout(data, offsets)
    steps, found = responses(w, at.padded)
    n, chunks = len(labels), len(at.chunk_starts)
    places = np.minimum(at.chunk_starts[:, None] + np.arange(CHUNK), at.chunk_ends[:, None] - 1)
    best = np.take_along_axis(places, found[places].argmax(axis=1), axis=1)
    raw = np.take_along_axis(found, best, axis=0) + w.bias
    pooled = np.maximum(raw, 0)
    counts = np.diff(np.append(at.first_chunk, chunks))
    means = np.add.reduceat(pooled, at.first_chunk, axis=0) / counts[:, None]
    logits = means @ w.out + w.offset[0]
    error = ((1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) / n).astype(np.float32)
    share = np.repeat(error / counts, counts)[:, None] * w.out * (raw > 0)
    first = np.einsum("cf,cfd->df", share, steps[best], optimize=True)
    second = np.einsum("cf,cfd->df", share, steps[best + 1], optimize=True)
    embedding = np.zeros((256, EMBEDDED), np.float32)
    grouped = at.padded.reshape(-1, STEP)
    for side, which in ((w.first, best), (w.second, best + 1)):
        parts = (share[:, :, None] * side.T[None]).reshape(-1, EMBEDDED)
        codes = grouped[which].reshape(-1)
        for k in range(EMBEDDED):
            embedding[:, k] += np.bincount(codes, parts[:, k], 256).astype(np.float32)
    return Weights(embedding, first, second, share.sum(0), error @ means, error.sum(keepdims=True))


def train(texts: list[str], labels: np.ndarray, epochs: int = 6, size: int = 48, rate: float = 0.01, seed: int = 7) -> Weights:
    """Adam over whole texts in small batches. Without both labels, the share of label 1 is learned."""
    w = start(seed)
    if len(texts) == 0:
        return w._replace(out=np.zeros(FILTERS, np.float32))
    column = pa.array(texts, pa.large_string())
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(x) for x in w]
    second = [np.zeros_like(x) for x in w]
    steps, total = 0, epochs * -(-len(texts) // size)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for begin in range(0, len(texts), size):
            chosen = order[begin : begin + size]
            grads = gradients(w, *batches.bytes_and_offsets(column.take(pa.array(chosen))), labels[chosen])
            steps += 1
            now = rate * (1 - (steps - 1) / total)
            moved = []
            for x, g, m, v in zip(w, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                moved.append((x - now * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)).astype(np.float32))
            w = Weights(*moved)
    return w


def held_out(doc_id: Column) -> Column:
    """Documents that labels are never learned from: crc32 of the id's digits, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Weights:
    """Train on a bounded sample of ``labels(doc_id, quality)`` that are not held out."""
    known = labelled.sample(
        docs, labels, F.col("quality").cast("int"), TRAIN_ROWS, TRAIN_BYTES, ~held_out(F.col("doc_id")) & F.col("label").isin(0, 1)
    )
    rows = known.orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
    return train(rows["text"].tolist(), rows["label"].to_numpy(np.float32))


def score(docs: DataFrame, w: Weights, keep_from: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every whole text of ``docs(doc_id, text)``.

    A null text counts as empty and is scored as such; null ids are not held out; repeated rows are
    scored once each.
    """

    def scored(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(rows, limit=SLICE_BYTES):
            found = probabilities(w, *batches.bytes_and_offsets(batches.text_of(part)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= keep_from).cast("int").alias("predicted")
    )
