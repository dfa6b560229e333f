"""Groups of spelling variants: words one edit apart, each led to its commonest form.

Near words are found by search schemes on a bidirectional full-text index (``fm_index``): one error
leaves one half of a word as it is, so the left half is matched exactly and extended to the right
with one error, and the right half to the left. The vocabulary is dealt out by the first symbols for
the one search and by the last symbols for the other: a near word always lies in the same block. A
block has an index of its own; a frequent beginning or ending is cut into pieces, and every piece of
its queries meets every piece of its index.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm import batches, fm_index
from rankloom.plans import joins, scratch

# Words of a block; a beginning or ending with more is cut into pieces of about so many.
BLOCK_WORDS = 50_000
STRETCH_BYTES = 4 << 20
# Longer runs are hashed one by one.
SIDE_BY_SIDE = 48


def crc_table() -> np.ndarray:
    """The 256 steps of the usual 32-bit cyclic redundancy check, from its polynomial."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = (steps >> np.uint32(1)) ^ np.where(steps & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return steps


CRC_STEPS = crc_table()
LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
LOWER = np.array([ord(chr(b).lower()) if b < 128 else b for b in range(256)], np.uint8)
# U+00C0 to U+00FF are this byte and one more in UTF-8.
LEAD = 0xC3


def crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Check sums of byte ranges, each going on from the check sum of what comes before it."""
    order = np.argsort(-sizes, kind="stable")
    long = int(np.searchsorted(-sizes[order], -SIDE_BY_SIDE, side="left"))
    state = ~before[order].astype(np.uint32)
    at, left = starts[order], sizes[order]
    for k in range(int(left[long]) if long < len(left) else 0):
        some = slice(long, int(np.searchsorted(-left, -k, side="left")))
        state[some] = CRC_STEPS[(state[some] ^ data[at[some] + k]) & np.uint32(255)] ^ (state[some] >> np.uint32(8))
    state = ~state
    for i in range(long):
        state[i] = zlib.crc32(data[at[i] : at[i] + left[i]].tobytes(), int(before[order[i]]))
    result = np.empty_like(state)
    result[order] = state
    return result


def runs(data: np.ndarray, offsets: np.ndarray, ids: list[str], least: int, modulus: int) -> Iterator[pa.RecordBatch]:
    """``(word, n)`` of the letter runs of a slice of texts, some of them with a letter deleted."""
    letter = LETTER[data] | (data == LEAD)
    letter[1:] |= data[:-1] == LEAD
    prefixes = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = 0
    while begin < len(data):
        end = begin + STRETCH_BYTES
        while end < len(data) and letter[end] and not edge[end]:
            end += 1
        end = min(end, len(data))
        part, own = LOWER[data[begin:end]], letter[begin:end]
        cut = edge[begin : end + 1]
        first = np.flatnonzero(own & (np.append(True, ~own[:-1]) | cut[:-1]))
        last = np.flatnonzero(own & (np.append(~own[1:], True) | cut[1:])) + 1
        text = np.searchsorted(offsets, first + begin, side="right") - 1
        leads = np.concatenate([[0], np.cumsum(part == LEAD)])
        points = (last - first) - (leads[last] - leads[first])
        keep = points >= least
        first, last, text, points = first[keep], last[keep], text[keep], points[keep]
        hashed = crcs(part, first, last - first, prefixes[text])
        changed = hashed % np.uint32(modulus) == 0
        plain = ~changed
        edges = np.concatenate([[0], np.cumsum((last - first)[plain])])
        kept = part[batches.gather(first[plain], (last - first)[plain])]
        words = pa.LargeStringArray.from_buffers(int(plain.sum()), pa.py_buffer(edges), pa.py_buffer(kept))
        counted = words.value_counts()
        yield pa.RecordBatch.from_arrays([counted.field(0).cast(pa.string()), counted.field(1)], ["word", "n"])
        shorter: Counter[str] = Counter()
        for i in np.flatnonzero(changed):
            run = part[first[i] : last[i]].tobytes().decode()
            place = int(hashed[i]) % len(run)
            if len(run) > least:
                shorter[run[:place] + run[place + 1 :]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(shorter.keys(), pa.string()), pa.array(shorter.values(), pa.int64())], ["word", "n"])
        begin = end


def vocabulary(docs: DataFrame, least: int = 5, at_least: int = 3, modulus: int = 97) -> DataFrame:
    """``(word, n)``: words of at least ``least`` code points that occur ``at_least`` times.

    Runs of Latin letters with A-Z lower-cased. Where ``modulus`` divides the check sum h of
    ``<doc_id>:<run>``, the run's letter ``h % length`` is deleted. A null id counts as empty, a null
    text has no runs. Words are counted in the tasks before they are shuffled.
    """

    def made(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(rows):
            data, offsets = batches.bytes_and_offsets(batches.text_of(part))
            yield from runs(data, offsets, part.column("id").to_pylist(), least, modulus)

    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    counted = docs.select(ids.alias("id"), "text").mapInArrow(made, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least)


def blocks(words: DataFrame, least: int) -> DataFrame:
    """``(block, side, role, word, n)``: index words (role 0), queries (1) or both (2) of each block.

    Side 0 is dealt out by the first ``least // 2`` symbols, which lie in the left half of every word;
    side 1 by the last ``least - least // 2``, which lie in the right half.
    """
    left, right = least // 2, least - least // 2
    key = F.when(F.col("side") == 0, F.substring("word", 1, left)).otherwise(F.substring("word", -right, right))
    sided = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")).withColumn("key", key)
    keys = scratch.materialise(
        sided.groupBy("side", "key").agg(F.ceil(F.count("*") / BLOCK_WORDS).cast("int").alias("pieces")), "variant-keys"
    )
    many = max(1, -(-words.count() // BLOCK_WORDS))
    dealt = joins.lookup_join(sided, keys, ["side", "key"], spread_by="word")
    whole = dealt.where("pieces = 1").select(
        F.xxhash64("side", F.pmod(F.xxhash64("key"), F.lit(many))).alias("block"), "side", F.lit(2).alias("role"), "word", "n"
    )
    own: Column = F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int")
    cut = dealt.where("pieces > 1").select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"))
    cut = cut.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("role"))
    i, j = (F.when(F.col("role") == r, F.col("own")).otherwise(F.col("other")) for r in (0, 1))
    return whole.union(cut.select(F.xxhash64("side", "key", i, j).alias("block"), "side", "role", "word", "n"))


def near_in_block(table: pa.Table) -> pa.Table:
    """``(word, near, near_n)`` of one block."""
    found = []
    for side in (0, 1):
        own = table.filter(pc.equal(table["side"], side))
        indexed = own.filter(pc.not_equal(own["role"], 1))
        asked = own.filter(pc.not_equal(own["role"], 0))["word"].combine_chunks()
        if not len(asked) or not indexed.num_rows:
            continue
        backwards = side == 0
        queries = fm_index.Words(asked.to_pylist(), backwards)
        index = fm_index.SuffixRanks(fm_index.Words(indexed["word"].to_pylist(), backwards))
        half = queries.lengths // 2
        query, word = fm_index.one_error(index, queries, half if backwards else queries.lengths - half)
        near = indexed.take(pa.array(word))
        found.append(pa.table({"word": asked.take(pa.array(query)), "near": near["word"], "near_n": near["n"]}))
    nothing = pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.string()), "near_n": pa.array([], pa.int64())})
    return pa.concat_tables([nothing, *found])


def near_words(words: DataFrame, least: int = 5) -> DataFrame:
    """``(word, near, near_n)``: all pairs of ``words(word, n)`` that are one edit apart, both ways.

    Words must be distinct and have at least ``least`` code points, two or more.
    """
    return blocks(words, least).groupBy("block").applyInArrow(near_in_block, "word string, near string, near_n long").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``: the end of each chain of forms, by pointer jumping."""
    ends = scratch.materialise(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("end"))
        moved = ends.join(further, "root", "left").select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved"))
        ends = scratch.materialise(moved, "variant-roots")
        if ends.where("moved").isEmpty():
            return ends.select("word", "root")


def variants(docs: DataFrame, least: int = 5, at_least: int = 3, modulus: int = 97) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the vocabulary of ``docs(doc_id, text)``.

    ``form`` is the near word of largest ``n`` (ties: the smallest in code-point order) if it has at
    least twice the word's own ``n``, else null; ``root`` is where the forms lead, the word itself
    without one. Empty tables and texts give no words; repeated rows count as often as they are there.
    """
    words = scratch.materialise(vocabulary(docs, least, at_least, modulus), "vocabulary")
    near = near_words(words, least).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    has_form = -F.col("best.less") >= 2 * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best.form")).alias("form"),
        F.when(has_form, -F.col("best.less")).alias("form_n"),
    )
    formed = scratch.materialise(formed, "variant-forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
