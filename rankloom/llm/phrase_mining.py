"""Phrase collocations by partitioned mining: locally frequent phrases first, then exact counts.

Documents are dealt into ``SHARDS`` shards. Every shard is mined completely, level by level, at a
support lowered in proportion to its share of the words: a phrase that is frequent in the whole is
frequent in one shard at least. The union of the shards' phrases is the candidate set, and a last
pass counts its members exactly over all documents. A shard is a share of the corpus and not of a
task: its phrases are counted by a shuffle, so it may be of any size, and the number of shards does
not grow with the data (with an absolute support, many small shards would lower it to one
occurrence).

Texts are turned once into stored rows of 64-bit word hashes, different for each language. What is
frequent goes to the tasks as a bit map of hashes of fixed size: a phrase that passes by collision is
only counted in vain. For the same reason a shard's phrases move as sorted hashes cut to some 30 bits,
of which only the gaps are written: about three bytes for each phrase. Phrases are told apart by the hashes of all their words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm import batches, shingles
from rankloom.plans import joins, scratch

SHARDS = 8
# Bits of a filter: 2 ** 25, four megabytes.
FILTER_BITS = 25
# Word places in a stored row, and places that a task counts at a time.
ROW_PLACES = 1 << 20
PLACES_AT_ONCE = 1 << 18
# The same where phrases are looked for, occurrences of a shard's block of hashes, bits of a hash inside its block,
# and bytes of such blocks that a task merges at a time.
PHRASES_AT_ONCE, BLOCK_PHRASES, BLOCK_BITS = 1 << 19, 1 << 21, 26
MERGED_BYTES = 2 << 20
# Just below a power of two, to which the tables of the word hashes are rounded up.
STRETCH_BYTES = (1 << 20) - 1
# Distinct words that a task holds before it passes their counts on.
WORDS_HELD = 150_000
# Bytes between words, and bytes that also end a piece.
BETWEEN = np.zeros(256, np.uint8)
BETWEEN[list(b" \t")] = 1
BETWEEN[list(b".,;:!?\n\v\f\r")] = 2
FACTOR = np.uint64(0x9FB21C651E98DF25)


def split_words(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For each stretch: its lower-cased bytes, where words start and end, their texts and pieces.

    Pieces are numbered through the whole slice; a stretch ends where a word ends.
    """
    kind = BETWEEN[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, pieces = 0, 0
    while begin < len(data):
        end = begin + STRETCH_BYTES
        while end < len(data) and kind[end] == 0 and not edge[end]:
            end += 1
        end = min(end, len(data))
        part, solid, cut = shingles.LOWER[data[begin:end]], kind[begin:end] == 0, edge[begin : end + 1]
        first = np.flatnonzero(solid & (np.append(True, ~solid[:-1]) | cut[:-1]))
        last = np.flatnonzero(solid & (np.append(~solid[1:], True) | cut[1:])) + 1
        piece = pieces + np.cumsum((kind[begin:end] == 2) + cut[:-1].astype(np.int64))
        yield part, first, last, np.searchsorted(offsets, first + begin, side="right") - 1, piece[first]
        pieces, begin = int(piece[-1]), end


class WordCounts:
    """Words of a task with their language, hash and count, from many slices."""

    def __init__(self) -> None:
        self.parts: list[pa.Table] = []
        self.rows = 0

    def add(self, lang: pa.Array, w: np.ndarray, word: pa.Array, n: np.ndarray) -> None:
        self.parts.append(pa.table({"lang": lang, "w": w.view(np.int64), "word": word, "n": n}))
        self.rows += len(w)

    def merged(self) -> pa.Table:
        whole = pa.concat_tables(self.parts).combine_chunks()
        w = whole["w"].to_numpy()
        _, first, of = np.unique(w, return_index=True, return_inverse=True)
        counts = np.bincount(of, whole["n"].to_numpy()).astype(np.int64)
        return whole.take(pa.array(first)).set_column(3, "n", pa.array(counts))

    def flush(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """What is held, once it is too much; all of it in the end."""
        if not self.parts or not (last or self.rows > WORDS_HELD):
            return
        whole = self.merged()
        self.parts, self.rows = [whole], whole.num_rows
        if last or self.rows > WORDS_HELD // 2:
            self.parts, self.rows = [], 0
            for batch in whole.to_batches(max_chunksize=20_000):
                yield words_batch(**dict(zip(batch.schema.names, batch.columns)))
            pa.default_memory_pool().release_unused()


def word_rows(part: pa.RecordBatch, counted: WordCounts) -> Iterator[pa.RecordBatch]:
    """Rows of ``WORDS_SCHEMA`` with the places of a slice of ``(text, lang, shard, salt)``.

    The slice's words are added to ``counted``.
    """
    data, offsets = batches.bytes_and_offsets(batches.text_of(part))
    langs, shard = part.column("lang").to_pylist(), part.column("shard").to_numpy()
    salt = part.column("salt").to_numpy().view(np.uint64)
    _, group = np.unique(np.stack([salt.view(np.int64), shard.astype(np.int64)]), axis=1, return_inverse=True)
    group = group.ravel()
    found, texts, pieces = [], [], []
    for stretch, first, last, text, piece in split_words(data, offsets):
        if not len(first):
            continue
        hashes = batches.mix(shingles.range_hashes(stretch, first, last) ^ salt[text])
        hashes[hashes == 0] = 1
        distinct, place, counts = np.unique(hashes, return_index=True, return_counts=True)
        sizes = (last - first)[place]
        letters = stretch[batches.gather(first[place], sizes)]
        words = pa.LargeStringArray.from_buffers(len(place), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)])), pa.py_buffer(letters))
        counted.add(pa.array([langs[t] for t in text[place]], pa.string()), distinct, words.cast(pa.string()), counts)
        found.append(hashes)
        texts.append(text)
        pieces.append(piece)
    if not found:
        return
    hashes, texts, pieces = map(np.concatenate, (found, texts, pieces))
    order = np.argsort(group[texts], kind="stable")
    hashes, texts, pieces = hashes[order], texts[order], pieces[order]
    edges = np.append(np.flatnonzero(np.append(True, np.diff(group[texts]) != 0)), len(hashes))
    for a, b in zip(edges[:-1], edges[1:]):
        gap = np.append(False, np.diff(pieces[a:b]) != 0)
        places = np.zeros(b - a + int(gap.sum()), np.uint64)
        places[np.arange(b - a) + np.cumsum(gap)] = hashes[a:b]
        for at in range(0, len(places), ROW_PLACES):
            own = places[at : at + ROW_PLACES]
            # What follows a row's own places lets phrases reach over its end.
            blob = places[at : at + ROW_PLACES + LONGEST - 1].astype("<u8").tobytes()
            yield words_batch(lang=[langs[texts[a]]], shard=[int(shard[texts[a]])], places=[blob], own=[len(own)], n=[int((own != 0).sum())])


LONGEST = 5
WORDS_SCHEMA = pa.schema(
    [("lang", pa.string()), ("shard", pa.int32()), ("places", pa.binary()), ("own", pa.int64()), ("w", pa.int64()), ("word", pa.string()), ("n", pa.int64())]
)
WORDS_COLUMNS = "lang string, shard int, places binary, own long, w long, word string, n long"


def words_batch(**columns: object) -> pa.RecordBatch:
    rows = len(columns["n"])  # type: ignore[arg-type]
    made = {name: column if isinstance(column, pa.Array) else pa.array(column, WORDS_SCHEMA.field(name).type) for name, column in columns.items()}
    return pa.RecordBatch.from_arrays([made[f.name] if f.name in made else pa.nulls(rows, f.type) for f in WORDS_SCHEMA], schema=WORDS_SCHEMA)


def keys(words: np.ndarray) -> pa.Array:
    """The rows of a table of hashes as binary values, eight bytes for each word, the highest first."""
    edges = np.arange(len(words) + 1, dtype=np.int32) * (8 * words.shape[1])
    return pa.BinaryArray.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(words.astype(">u8")))])


def described(docs: DataFrame) -> DataFrame:
    """Stored rows: places of words by language and shard, and each language's words with counts."""

    def made(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = WordCounts()
        for part in batches.slices(rows, limit=STRETCH_BYTES):
            yield from word_rows(part, counted)
            yield from counted.flush()
        yield from counted.flush(last=True)

    lang = F.coalesce(F.col("lang"), F.lit("und"))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SHARDS)).cast("int")
    return docs.select("text", lang.alias("lang"), shard.alias("shard"), F.xxhash64(lang).alias("salt")).mapInArrow(made, WORDS_COLUMNS)


def hashes(places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the phrases of ``length`` words that start at each place, and which places have one."""
    n = max(len(places) - length + 1, 0)
    rolled, real = places[:n].copy(), places[:n] != 0
    for k in range(1, length):
        rolled = batches.mix(rolled) * FACTOR + places[k : k + n]
        real &= places[k : k + n] != 0
    return rolled, real


def passing(bits: np.ndarray, rolled: np.ndarray) -> np.ndarray:
    """Whether the bits of the hashes are set."""
    at = batches.mix(rolled) >> np.uint64(64 - FILTER_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def filter_places(words: DataFrame) -> DataFrame:
    """``(at)``: the places in a filter of the hashes in ``words(h)``."""

    def bits(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = batches.mix(batch.column("h").to_numpy().view(np.uint64)) >> np.uint64(64 - FILTER_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(at).view(np.int64))], ["at"])

    return words.mapInArrow(bits, "at long")


def bit_filter(places: DataFrame) -> Broadcast:
    """A bit map with the bits ``places(at)`` set, as a broadcast of ``2 ** FILTER_BITS`` bits."""
    spark = places.sparkSession
    places = places.select(F.bitmap_bucket_number(F.col("at") + 1).alias("bucket"), F.bitmap_bit_position(F.col("at") + 1).alias("bit"))
    maps = places.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    whole = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    # At most 2 ** (FILTER_BITS - 15) rows of four kilobytes, whatever the table's size.
    for row in maps.collect():
        whole[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(row.bits, np.uint8)
    return spark.sparkContext.broadcast(whole.tobytes())


def short_bytes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers from 0, seven bits to a byte, the lowest first, and where each one starts and the last ends.

    All bytes of a number but its last have the highest bit set.
    """
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 10):
        longer = values >= np.uint64(1 << (7 * k))
        if not longer.any():
            break
        sizes += longer
    edges = np.concatenate([[0], np.cumsum(sizes)])
    data = np.zeros(int(edges[-1]), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        own = np.flatnonzero(sizes > k)
        low = (values[own] >> np.uint64(7 * k)) & np.uint64(127)
        data[edges[own] + k] = low.astype(np.uint8) | ((sizes[own] > k + 1).astype(np.uint8) << 7)
    return data, edges


def from_short_bytes(data: np.ndarray) -> np.ndarray:
    """The numbers that :func:`short_bytes` wrote."""
    last = np.flatnonzero(data < 128)
    first = np.append(0, last[:-1] + 1) if len(last) else last
    values, sizes = np.zeros(len(last), np.int64), last - first + 1
    for k in range(int(sizes.max(initial=0))):
        own = np.flatnonzero(sizes > k)
        values[own] |= (data[first[own] + k] & 127).astype(np.int64) << (7 * k)
    return values


def in_blocks(keys: np.ndarray, times: np.ndarray) -> list[pa.Array]:
    """Ascending ``keys`` and how often each occurs as rows ``(block, gaps, times)``, one for each block of keys."""
    block = keys >> BLOCK_BITS
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    low = keys & ((1 << BLOCK_BITS) - 1)
    gaps = np.diff(low, prepend=0)
    gaps[starts] = low[starts]
    columns = []
    for values in (gaps, times - 1):
        data, edges = short_bytes(values)
        offsets = np.append(edges[starts], len(data)).astype(np.int32)
        columns.append(pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
    return [pa.array(block[starts]), *columns]


def from_blocks(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows of :func:`in_blocks`: each key's row, the key inside its block, and how often it occurs."""
    data, offsets = batches.bytes_and_offsets(part.column("gaps").cast(pa.large_binary()))
    before = np.concatenate([[0], np.cumsum(data < 128)])[offsets]
    row = np.repeat(np.arange(part.num_rows), np.diff(before))
    ends = np.cumsum(from_short_bytes(data))
    base = np.concatenate([[0], ends])[before[:-1]]
    counts, _ = batches.bytes_and_offsets(part.column("times").cast(pa.large_binary()))
    return row, ends - base[row], from_short_bytes(counts) + 1


def counted(
    rows: DataFrame, count: Callable[[np.ndarray, np.ndarray], Iterator[list]], names: list[str], schema: str, at_once: int | None = None
) -> DataFrame:
    """Apply ``count(places, own)`` to the places of each group ``g`` in a task, ``at_once`` at a time.

    ``rows(g, places, own)``; ``own`` flags the places at which a phrase may start.
    """

    def flush(held: dict[object, list[tuple[np.ndarray, int]]]) -> Iterator[pa.RecordBatch]:
        for g, parts in held.items():
            places = np.concatenate([x for p, _ in parts for x in (p, np.zeros(1, np.uint64))])
            own = np.concatenate([np.arange(len(p) + 1) < n for p, n in parts])
            for columns in count(places, own):
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array([g] * len(columns[0])), *columns], ["g", *names])

    limit = at_once or PLACES_AT_ONCE

    def made(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[object, list[tuple[np.ndarray, int]]] = {}
        size = 0
        for batch in batches_:
            for g, blob, own in zip(batch.column("g").to_pylist(), batch.column("places"), batch.column("own").to_pylist()):
                places = np.frombuffer(blob.as_buffer(), "<u8").astype(np.uint64)
                held.setdefault(g, []).append((places, own))
                size += len(places)
                if size >= limit:
                    yield from flush(held)
                    held, size = {}, 0
                    pa.default_memory_pool().release_unused()
        yield from flush(held)

    return rows.select("g", "places", "own").mapInArrow(made, schema)


def phrase_blocks(rows: DataFrame, shorter: Broadcast, length: int, split: int) -> DataFrame:
    """``(g, block, gaps, times)``: phrases of ``length`` words by shard, as hashes cut to ``BLOCK_BITS + split`` bits.

    Both parts of a phrase without its first or last word must pass the filter of the shorter ones. A row holds
    what a task has found in one of the ``2 ** split`` blocks of hashes: a few bytes for each phrase.
    """

    def count(places: np.ndarray, own: np.ndarray) -> Iterator[list]:
        bits = np.frombuffer(shorter.value, np.uint8)
        rolled, real = hashes(places, length - 1)
        fine = passing(bits, rolled) & real
        whole, real = hashes(places, length)
        n = len(whole)
        some = np.flatnonzero(real & own[:n] & fine[:n] & fine[1 : n + 1])
        found = batches.mix(whole[some]) >> np.uint64(64 - BLOCK_BITS - split)
        yield in_blocks(*np.unique(found.view(np.int64), return_counts=True))

    return counted(rows, count, ["block", "gaps", "times"], "g long, block long, gaps binary, times binary", PHRASES_AT_ONCE)


def frequent_places(rows: Iterator[pa.RecordBatch], split: int) -> Iterator[pa.RecordBatch]:
    """``(at)``: filter places of what has ``local`` occurrences, from rows ``(g, block, local, gaps, times)`` in order."""
    held: tuple[tuple[int, int, int], np.ndarray, np.ndarray] | None = None

    def places(block: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
        at = ((block << BLOCK_BITS) | low) >> (BLOCK_BITS + split - FILTER_BITS)
        return pa.RecordBatch.from_arrays([pa.array(np.unique(at))], ["at"])

    for part in batches.slices(rows, "gaps", MERGED_BYTES):
        g, block, local = (part.column(c).to_numpy() for c in ("g", "block", "local"))
        run = np.cumsum(np.append(False, (g[1:] != g[:-1]) | (block[1:] != block[:-1])))
        row, low, times = from_blocks(part)
        key = (run[row] << BLOCK_BITS) | low
        if held:
            (held_g, held_block, held_local), held_low, held_times = held
            if (held_g, held_block) == (g[0], block[0]):
                key, times = np.concatenate([held_low, key]), np.concatenate([held_times, times])
            else:
                yield places(np.int64(held_block), held_low[held_times >= held_local])
        distinct, of = np.unique(key, return_inverse=True)
        sums = np.bincount(of, times, len(distinct)).astype(np.int64)
        # The last block may go on in the next slice.
        open_from = np.searchsorted(distinct, int(run[-1]) << BLOCK_BITS)
        first = np.flatnonzero(np.diff(run, prepend=-1))
        own = first[distinct[:open_from] >> BLOCK_BITS]
        frequent = sums[:open_from] >= local[own]
        low = distinct & ((1 << BLOCK_BITS) - 1)
        yield places(block[own[frequent]], low[:open_from][frequent])
        held = (int(g[-1]), int(block[-1]), int(local[-1])), low[open_from:], sums[open_from:]
    if held:
        yield places(np.int64(held[0][1]), held[1][held[2] >= held[0][2]])


def mined(rows: DataFrame, groups: DataFrame, shorter: Broadcast, length: int, split: int) -> DataFrame:
    """``(at)``: filter places of the phrases of ``length`` words that are frequent in their shard.

    ``groups(g, local)`` holds the local support of each language and shard. Hashes that are equal in the bits that
    are kept are counted as one: such a phrase passes in vain.
    """
    blocks = joins.lookup_join(phrase_blocks(rows, shorter, length, split), groups, ["g"], spread_by="block")
    dealt = blocks.select("g", "block", "local", "gaps", "times").repartition("g", "block").sortWithinPartitions("g", "block")
    return dealt.mapInArrow(lambda found: frequent_places(found, split), "at long").distinct()


def exact_counts(rows: DataFrame, candidates: Broadcast) -> DataFrame:
    """``(g, phrase, n)``: occurrences of all phrases that pass the filter; a phrase is its words' hashes."""

    def count(places: np.ndarray, own: np.ndarray) -> Iterator[list]:
        bits = np.frombuffer(candidates.value, np.uint8)
        for length in range(1, LONGEST + 1):
            rolled, real = hashes(places, length)
            some = np.flatnonzero(real & own[: len(rolled)] & passing(bits, rolled))
            words = places[some[:, None] + np.arange(length)]
            _, first, of, times = np.unique(rolled[some], return_index=True, return_inverse=True, return_counts=True)
            if (words != words[first][of]).any():  # two phrases of one hash
                words, times = np.unique(words, axis=0, return_counts=True)
            else:
                words = words[first]
            yield [keys(words), pa.array(times)]

    found = counted(rows, count, ["phrase", "n"], "g string, phrase binary, n long")
    return found.groupBy("g", "phrase").agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, support: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables ``(lang, phrase, words, f)``, ``(lang, n)`` and ``(key, word)``, all stored.

    Every phrase of up to ``LONGEST`` words with ``f >= support`` occurrences in its language; the
    words that such phrases are made of; and the words of all texts by language.
    """
    rows = scratch.materialise(described(docs), "phrase-words")
    placed = rows.where("places IS NOT NULL")
    by_shard = scratch.materialise(placed.groupBy("lang", "shard").agg(F.sum("n").alias("n")), "phrase-shards")
    totals = by_shard.groupBy("lang").agg(F.sum("n").alias("n"))
    whole = totals.withColumnRenamed("n", "whole")
    groups = joins.lookup_join(by_shard, whole, ["lang"], spread_by="shard").select(
        F.xxhash64("lang", "shard").alias("g"), F.expr(f"({support} * n + whole - 1) div whole").alias("local")
    )
    words = rows.where("places IS NULL").select("w", "word", "n").repartition("w").groupBy("w", "word").agg(F.sum("n").alias("n"))
    words = scratch.materialise(words.where(F.col("n") >= support), "phrase-vocabulary")
    of_shard = placed.select(F.xxhash64("lang", "shard").alias("g"), "places", "own")
    most = by_shard.agg(F.max("n")).first()[0] or 1
    split = ((most - 1) // BLOCK_PHRASES).bit_length()
    candidates = single = filter_places(words.select(F.col("w").alias("h")))
    shorter = bit_filter(single)
    for length in range(2, LONGEST + 1):
        found = scratch.materialise(mined(of_shard, groups, shorter, length, split), "phrase-candidates")
        candidates = candidates.union(found)
        shorter.unpersist()
        shorter = bit_filter(found)
    shorter.unpersist()
    counts = exact_counts(placed.select(F.col("lang").alias("g"), "places", "own"), bit_filter(candidates))
    frequent = counts.where(F.col("n") >= support).select(
        F.col("g").alias("lang"), "phrase", (F.length("phrase") / 8).cast("int").alias("words"), F.col("n").alias("f")
    )
    return scratch.materialise(frequent, "phrases"), totals, words.select(F.unhex(F.lpad(F.hex("w"), 16, "0")).alias("key"), "word")


def collocations(docs: DataFrame, support: int = 100, first: int = 2000) -> DataFrame:
    """The ``first`` collocations of each language: ``(lang, rank, phrase, a, l, r, n, score)``.

    Texts ``docs(doc_id, text, lang)`` have A-Z lower-cased and are cut into pieces at sentence marks
    and line ends and into words at spaces and tabs. A candidate is a phrase of 2 to 5 words with
    ``a >= support`` occurrences in its language. A cut gives ``l`` and ``r``, the occurrences of its
    parts, and ``floor(1000 * a * n / (l * r))``; the lowest cut counts, ties to the shortest first
    part. Candidates inside a longer one that is as frequent are dropped. Ties of score and ``a`` go
    by the phrase's bytes. A null language is ``und``; null and empty texts have no words; repeated
    rows count as often as they are there; an empty table gives no rows.
    """
    phrases, totals, vocabulary = frequent_phrases(docs, support)
    counts = phrases.select(F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    small = joins.small_table(counts)

    def with_count(df: DataFrame, of: str, name: str) -> DataFrame:
        right = counts.select(F.col("part").alias(of), F.col("part_f").alias(name))
        return df.join(F.broadcast(right), of) if small else joins.split_join(df, right, [of], spread_by="phrase")

    several = phrases.where("words > 1")
    # One word more is enough: whatever lies between two phrases of equal counts has that count too.
    longer = several.where("words > 2").select(
        F.explode(F.array(F.expr("substring(phrase, 1, 8 * (words - 1))"), F.expr("substring(phrase, 9, 8 * (words - 1))"))).alias("phrase"), "f"
    )
    longer = longer.groupBy("phrase").agg(F.max("f").alias("most"))
    kept = several.join(longer, "phrase", "left").where("most IS NULL OR most < f").select("lang", "phrase", "words", F.col("f").alias("a"))
    kept = joins.lookup_join(kept, totals, ["lang"], spread_by="phrase")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")).select(
        "*", F.expr("substring(phrase, 1, 8 * cut)").alias("left_part"), F.expr("substring(phrase, 8 * cut + 1, 8 * (words - cut))").alias("right_part")
    )
    cuts = with_count(with_count(cuts, "left_part", "l"), "right_part", "r")
    score = F.expr("(CAST(1000 * a AS DECIMAL(18, 0)) * CAST(n AS DECIMAL(18, 0))) div (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("lowest"))
    scored = scored.select("lang", F.col("phrase").alias("id"), "a", "n", "lowest.score", "lowest.l", "lowest.r")
    # Ties at the last rank stay until their words are known.
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    near = scratch.materialise(scored.withColumn("place", F.rank().over(best)).where(F.col("place") <= first).drop("place"), "phrase-best")
    spelled = near.select("lang", "id", F.explode(F.sequence(F.lit(1), (F.length("id") / 8).cast("int"))).alias("place"))
    spelled = joins.lookup_join(spelled.withColumn("key", F.expr("substring(id, 8 * place - 7, 8)")), vocabulary, ["key"], spread_by="id")
    texts = spelled.groupBy("lang", "id").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    texts = texts.select("lang", "id", F.array_join(F.col("words.word"), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = near.join(texts, ["lang", "id"]).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
