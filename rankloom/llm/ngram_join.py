"""Jaccard join of n-gram sets, filtered by prefixes under several global token orders.

Every order ranks all tokens; a set's prefix under it is its first few tokens. Two sets of the wanted
similarity share a known number of prefix tokens under *every* order, so the filters are intersected:
a set stays in the race only if, order by order, enough of its prefix tokens occur in other sets that
are still in it. All orders put tokens that are common in the corpus last and differ in how they mix
the rest.

Sets that share a token of the plain prefix are candidates of each other. First each group of them is
compared with its smallest member, which connects groups of copies; groups that are still in
several components are then compared in pieces of bounded size. A pair is verified on full sets only if
small bit maps of all tokens, which bound what two sets share, leave it possible.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.llm import batches, components, shingles
from rankloom.plans import joins, scratch

SALTS = batches.mix(np.arange(1, 4, dtype=np.uint64) * np.uint64(0xA3B195354A39B70D))
ORDERS = ("first", "second", "third")
# Tokens found so often in a task, and so often in all, may count as common; at most so many do.
COMMON_IN_TASK, COMMON_FROM, COMMON_TOKENS = 4, 16, 1 << 20
# Rounds in which the first order's filter is applied to what it left.
ROUNDS = 2
PIECE_SETS = 256
# Bytes of bit maps that are compared at once.
MAP_BYTES = 4 << 20
# Smallest members that each set is compared with first: those with which it shares most tokens.
CENTRES = 2
# Rounds in which each component tries its likeliest pairs, before all pairs that are left are compared.
JOINING_ROUNDS = 3
BROADCAST_IDS = 1_000_000


def ceil_share(n: np.ndarray, percent: int) -> np.ndarray:
    """``percent`` hundredths of ``n``, rounded up."""
    return (n * percent + 99) // 100


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of which similar sets share one at least."""
    return n - ceil_share(n, percent) + 1


def held_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of a prefix that are kept, so that similar sets share about half of them."""
    return np.minimum(n, 2 * prefix_length(n, percent) - 1)


def least_shared(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of the kept prefix tokens a set of size ``n`` shares with any one similar set."""
    other = ceil_share(n, percent)
    return held_length(other, percent) - other + ceil_share(other, percent)


def overlap(n: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that similar sets of these sizes have in common at least."""
    return -(-percent * (n + other) // (100 + percent))


def common_tokens(docs: DataFrame, width: int) -> DataFrame:
    """``(h, df)`` of the most common tokens, at most ``COMMON_TOKENS``; ``df`` is a lower bound."""

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        tokens, of = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        return tokens, np.bincount(of, np.concatenate([n for _, n in held]), len(tokens)).astype(np.int64)

    def made(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for part in batches.slices(rows):
            sets, _ = shingles.sets(*batches.bytes_and_offsets(batches.text_of(part)), width)
            tokens, counts = np.unique(sets, return_counts=True)
            held.append((tokens[counts > 1], counts[counts > 1]))
            if len(held) == 16:
                held = [merged(held)]
        if held:
            tokens, counts = merged(held)
            often = counts >= COMMON_IN_TASK
            yield pa.RecordBatch.from_arrays([pa.array(tokens[often].view(np.int64)), pa.array(counts[often])], ["h", "df"])

    found = docs.select("text").mapInArrow(made, "h long, df long").groupBy("h").agg(F.sum("df").alias("df"))
    return found.where(F.col("df") >= COMMON_FROM).orderBy(F.col("df").desc(), "h").limit(COMMON_TOKENS)


class Orders:
    """Ranks of tokens under each order: commonness by powers of two first, then a hash."""

    def __init__(self, tokens: np.ndarray, df: np.ndarray) -> None:
        place = np.argsort(tokens)
        self.tokens, self.level = tokens[place], np.log2(df[place]).astype(np.uint64)

    def ranks(self, sets: np.ndarray, order: int) -> np.ndarray:
        rank = batches.mix(sets ^ SALTS[order]) >> np.uint64(8)
        if len(self.tokens):
            place = np.minimum(np.searchsorted(self.tokens, sets), len(self.tokens) - 1)
            rank |= np.where(self.tokens[place] == sets, self.level[place], np.uint64(0)) << np.uint64(56)
        return rank


def prefixes(sets: np.ndarray, edges: np.ndarray, ranks: np.ndarray, percent: int) -> pa.ListArray:
    """The kept prefix of each set; ties of rank go by the token."""
    sizes = held_length(np.diff(edges), percent) * (np.diff(edges) > 0)
    parts = [sets[a:b][np.argsort(ranks[a:b], kind="stable")[:m]] for a, b, m in zip(edges[:-1], edges[1:], sizes)]
    values = np.concatenate(parts) if parts else sets[:0]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values.view(np.int64)))


def common_orders(tokens: Broadcast) -> Orders:
    """The orders that the broadcast table of common tokens gives."""
    blob, rows = tokens.value
    return Orders(np.frombuffer(blob, np.uint64, rows), np.frombuffer(blob, np.int64, rows, 8 * rows))


def described(docs: DataFrame, width: int, percent: int, tokens: Broadcast) -> DataFrame:
    """``(doc_id, n, f, g, first)``: set size, 128-bit fingerprint and prefix under the first order."""

    def made(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = common_orders(tokens)
        for part in batches.slices(rows):
            sets, edges = shingles.sets(*batches.bytes_and_offsets(batches.text_of(part)), width)
            some = np.flatnonzero(np.diff(edges))
            f, g = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
            if len(some):
                f[some] = np.add.reduceat(batches.mix(sets), edges[some]).view(np.int64)
                g[some] = np.bitwise_xor.reduceat(batches.mix(sets + shingles.BASE), edges[some]).view(np.int64)
            held = prefixes(sets, edges, orders.ranks(sets, 0), percent)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(edges)), pa.array(f), pa.array(g), held], ["doc_id", "n", "f", "g", "first"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(made, "doc_id long, n long, f long, g long, first array<long>")


def with_sets(docs: DataFrame, alive: DataFrame, width: int, percent: int, tokens: Broadcast) -> DataFrame:
    """``(v, n, need, size, first, second, third, set)`` of the sets still in the race.

    ``need`` is how many prefix tokens must be shared, ``size`` the length of the plain prefix.
    """
    alive = scratch.materialise(alive, "join-alive")
    few = joins.fits(alive.count(), BROADCAST_IDS)
    held = docs.select(F.col("doc_id").cast("long").alias("v"), "text").join(joins.broadcast_if(alive, few), "v", "left_semi")

    def made(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = common_orders(tokens)
        for part in batches.slices(rows):
            sets, edges = shingles.sets(*batches.bytes_and_offsets(batches.text_of(part)), width)
            n = np.diff(edges)
            blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(edges * 8), pa.py_buffer(sets)])
            held = [prefixes(sets, edges, orders.ranks(sets, o), percent) for o in range(len(ORDERS))]
            columns = [part.column("v"), pa.array(n), pa.array(least_shared(n, percent)), pa.array(prefix_length(n, percent)), *held, blobs.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["v", "n", "need", "size", *ORDERS, "set"])

    schema = "v long, n long, need long, size long, first array<long>, second array<long>, third array<long>, set binary"
    return held.mapInArrow(made, schema).where("n > 0")


def still_alive(rows: DataFrame, order: str) -> DataFrame:
    """``(v)`` of the sets with enough prefix tokens that occur in other sets of ``rows(v, need, order)``.

    Counts are combined before the shuffle; a token of very many sets is cut into pieces.
    """
    tokens = rows.select("v", "need", F.explode(order).alias("h"))
    counts = scratch.materialise(tokens.groupBy("h").agg(F.count("*").alias("rows")).where("rows > 1"), "join-tokens")
    found = joins.split_join(tokens, counts.select("h"), ["h"], "left_semi", spread_by="v", counts=counts)
    return found.groupBy("v").agg(F.count("*").alias("found"), F.min("need").alias("need")).where("found >= need").select("v")


def group_rows(sets: DataFrame) -> DataFrame:
    """``(h, v, n)``: the tokens of each set's plain prefix under the first order."""
    return sets.select("v", "n", F.explode(F.slice("first", F.lit(1), F.col("size").cast("int"))).alias("h"))


def sketched(sets: DataFrame) -> DataFrame:
    """``(v, n, bits)``: a bit map of each set's tokens, with four to eight bits for each of ``n`` tokens.

    A bit that only one of two sets has stands for a token that the other one lacks, so bit maps bound what
    sets share (:func:`most_shared`), in a sixteenth to an eighth of the sets' bytes.
    """

    def made(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            maps = [bit_map(np.frombuffer(x.as_buffer(), np.uint64)) for x in batch.column("set")]
            yield pa.RecordBatch.from_arrays([batch.column("v"), batch.column("n"), pa.array(maps, pa.binary())], ["v", "n", "bits"])

    return sets.select("v", "n", "set").mapInArrow(made, "v long, n long, bits binary")


def bit_map(tokens: np.ndarray) -> bytes:
    """Bits at the lowest digits of the mixed tokens; their number is a power of two."""
    size = 1 << max(6, (4 * len(tokens) - 1).bit_length())
    flags = np.zeros(size, bool)
    flags[(batches.mix(tokens) & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(flags).tobytes()


def most_shared(x: np.ndarray, y: np.ndarray, n: int, other: int) -> int:
    """At most so many tokens are in both sets, by their bit maps; the larger map is folded to the smaller."""
    size = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(m.reshape(-1, size), axis=0) for m in (x, y))
    return min(n - int(np.bitwise_count(x & ~y).sum()), other - int(np.bitwise_count(y & ~x).sum()))


def attached(left: DataFrame, right: DataFrame, name: str, few: bool, column: str) -> DataFrame:
    """``left`` with ``column`` of the rows of ``right(v, column)`` that ``name`` says, as ``{name}_{column}``."""
    right = right.select(F.col("v").alias(name), F.col(column).alias(f"{name}_{column}"))
    return right.join(F.broadcast(left), name) if few else joins.split_join(left, right, [name], spread_by=F.xxhash64("a", "b"))


def likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """``(a, b, shared)``: those of the stored ``pairs(a, b)`` whose sets may be similar, and what they share at most."""
    few = joins.fits(pairs.count())
    joined = pairs.select("a", "b")
    rows = sketches.select("v", F.struct("n", "bits").alias("map"))
    joined = attached(attached(joined, rows, "a", few, "map"), rows, "b", False, "map")

    def decide(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            n, other = batch.column("n").to_numpy(), batch.column("other").to_numpy()
            maps = [[np.frombuffer(x.as_buffer(), np.uint8) for x in batch.column(c)] for c in ("x", "y")]
            shared = np.array([most_shared(*pair) for pair in zip(*maps, n, other)], np.int64)
            fine = pa.array(shared >= overlap(n, other, percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared)], ["a", "b", "shared"]).filter(fine)

    sides = joined.select("a", "b", F.col("a_map.n").alias("n"), F.col("a_map.bits").alias("x"), F.col("b_map.n").alias("other"), F.col("b_map.bits").alias("y"))
    return sides.mapInArrow(decide, "a long, b long, shared long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: those of the stored ``pairs(a, b)`` that are similar, by their full sets.

    Few pairs are sent to where the sets of one side lie, and only sets that they name are shuffled.
    """
    few = joins.fits(pairs.count())
    joined = pairs.select("a", "b")
    joined = attached(joined, sets, "b", few, "set")
    ends = sets.join(F.broadcast(pairs.select(F.col("a").alias("v"))), "v", "left_semi") if few else sets
    joined = attached(joined, ends, "a", False, "set")

    def decide(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ends = [[np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(c)] for c in ("a_set", "b_set")]
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(*ends)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return joined.select("a", "b", "a_set", "b_set").mapInArrow(decide, "a long, b long")


def near_pairs(maps: list[np.ndarray], n: np.ndarray, fine: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs in ``fine`` whose sets may be similar by size and bit map, and what they share at most."""
    smaller, larger = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    i, j = np.nonzero(np.triu(fine & (100 * smaller >= percent * larger), 1))
    lengths = np.array([len(x) for x in maps])
    swap = lengths[i] > lengths[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    most = np.zeros(len(i), np.int64)
    for size in np.unique(lengths[i]):
        own = np.flatnonzero(lengths[i] == size)
        # Larger maps are folded to the smaller ones of their pairs.
        place = np.full(len(maps), -1)
        used = np.unique(np.concatenate([i[own], j[own]]))
        place[used] = np.arange(len(used))
        table = np.stack([np.bitwise_or.reduce(maps[r].reshape(-1, size), axis=0).view(np.uint64) for r in used])
        step = max(1, MAP_BYTES // int(size))
        for at in range(0, len(own), step):
            some = own[at : at + step]
            x, y = table[place[i[some]]], table[place[j[some]]]
            most[some] = np.minimum(n[i[some]] - np.bitwise_count(x & ~y).sum(axis=1), n[j[some]] - np.bitwise_count(y & ~x).sum(axis=1))
    near = most >= overlap(n[i], n[j], percent)
    return i[near], j[near], most[near]


def likely_pairs(members: DataFrame, calls: int, percent: int) -> DataFrame:
    """``(a, b, shared)``: pairs of a group's members in different components that may be similar by their bit maps.

    ``members(h, pieces, v, root, n, bits)``. A group of several pieces is compared piece by piece, so that
    a call holds two of them at most; small groups share ``calls`` calls.
    """
    own = F.pmod(F.xxhash64("v"), F.col("pieces")).cast("int")
    cut = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    unit = F.xxhash64("h", F.least("own", "other"), F.greatest("own", "other"))
    dealt = cut.select("v", "root", "n", "bits", unit.alias("unit"), F.when(F.col("pieces") > 1, unit).otherwise(F.pmod(F.xxhash64("h"), F.lit(calls))).alias("deal"))

    def decide(table: pa.Table) -> pa.Table:
        v, root, n, unit = (table[c].to_numpy() for c in ("v", "root", "n", "unit"))
        order = np.argsort(unit, kind="stable")
        maps = table["bits"].combine_chunks()
        found = []
        for rows in np.split(order, np.flatnonzero(np.diff(unit[order])) + 1):
            if len(np.unique(root[rows])) < 2:
                continue
            held = [np.frombuffer(maps[int(r)].as_buffer(), np.uint8) for r in rows]
            i, j, most = near_pairs(held, n[rows].astype(np.int64), root[rows][:, None] != root[rows][None, :], percent)
            ends = np.stack([v[rows[i]], v[rows[j]]])
            found.append(np.stack([ends.min(axis=0), ends.max(axis=0), most]))
        # A pair of several groups leaves the call once.
        pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((3, 0), np.int64)
        return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1]), "shared": pa.array(pairs[2])})

    return dealt.groupBy("deal").applyInArrow(decide, "a long, b long, shared long").where("a <> b").groupBy("a", "b").agg(F.max("shared").alias("shared"))


def similar_sets(sets: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: links that connect all similar sets of ``sets``, not every similar pair."""
    rows = group_rows(sets)
    groups = scratch.materialise(rows.groupBy("h").agg(F.min(F.struct("v", "n")).alias("low"), F.count("*").alias("rows")).where("rows > 1"), "join-groups")
    stars = joins.split_join(rows, groups.select("h", F.col("low.v").alias("centre"), F.col("low.n").alias("centre_n"), (F.col("rows") == 2).alias("alone")), ["h"], spread_by="v", counts=groups.select("h", "rows"))
    stars = stars.where(f"v <> centre AND 100 * least(n, centre_n) >= {percent} * greatest(n, centre_n)")
    stars = stars.groupBy("v", "centre").agg(F.count("*").alias("shared"), F.bool_or("alone").alias("alone"))
    closest = Window.partitionBy("v").orderBy(F.col("shared").desc(), "centre")
    stars = stars.withColumn("place", F.row_number().over(closest)).where((F.col("place") <= CENTRES) | F.col("alone"))
    stars = scratch.materialise(stars.select(F.col("centre").alias("a"), F.col("v").alias("b")), "join-stars")
    sketches = scratch.materialise(sketched(sets), "join-sketches")
    nearest = Window.partitionBy("b").orderBy(F.col("shared").desc(), "a")
    near = scratch.materialise(likely(stars, sketches, percent).withColumn("place", F.row_number().over(nearest)), "join-near")
    best = scratch.materialise(near.where("place = 1").select("a", "b"), "join-best")
    linked = scratch.materialise(verified(best, sets, percent), "join-links")
    # Each set is compared with its nearest centre; the other centres, and pairs alone in their group, which no
    # larger group holds, wait with the other pairs.
    waiting = near.where("place > 1").select("a", "b", "shared")
    roots = components.components(linked).withColumnRenamed("root", "_root")
    placed = rows.join(roots, "v", "left").select("h", "v", F.coalesce("_root", "v").alias("root"))
    counts = groups.where("rows > 2").select("h", "rows")
    large = joins.split_join(placed, counts.select("h"), ["h"], "left_semi", spread_by="v", counts=counts)
    # A group of one component is done, and one of two sets is tried or waits; groups of equal members count once.
    apart = large.groupBy("h").agg(
        F.count("*").alias("rows"), F.min("root").alias("low"), F.max("root").alias("high"), F.sum(F.xxhash64("v").cast("decimal(38, 0)")).alias("sum"), F.bit_xor(F.xxhash64("v")).alias("mixed")
    ).where("low <> high")
    apart = apart.groupBy("rows", "sum", "mixed").agg(F.min("h").alias("h")).select("h", "rows")
    apart = scratch.materialise(apart, "join-apart")
    pieces = apart.select("h", F.ceil(F.col("rows") / PIECE_SETS).cast("int").alias("pieces"))
    members = joins.split_join(placed, pieces, ["h"], spread_by="v", counts=apart)
    members = members.join(sketches, "v")
    calls = max(1, (apart.agg(F.sum("rows")).first()[0] or 0) // PIECE_SETS)
    pairs = likely_pairs(members, calls, percent).unionByName(waiting).groupBy("a", "b").agg(F.max("shared").alias("shared"))
    pairs = scratch.materialise(pairs, "join-pairs")
    # Each component tries its likeliest pairs first: what they connect need not be compared any more.
    for _ in range(JOINING_ROUNDS):
        apart_pairs = in_different_components(pairs, linked)
        ends = apart_pairs.select("a", "b", "shared", F.explode(F.array("a_root", "b_root")).alias("root"))
        best = Window.partitionBy("root").orderBy(F.col("shared").desc(), "a", "b")
        chosen = ends.withColumn("place", F.row_number().over(best)).where(F.col("place") <= CENTRES).select("a", "b").distinct()
        chosen = scratch.materialise(chosen, "join-chosen")
        if chosen.isEmpty():
            return linked
        linked = scratch.materialise(linked.union(verified(chosen, sets, percent)), "join-links")
        pairs = scratch.materialise(pairs.join(chosen, ["a", "b"], "left_anti"), "join-pairs")
    rest = scratch.materialise(in_different_components(pairs, linked).select("a", "b"), "join-rest")
    return linked.union(verified(rest, sets, percent))


def in_different_components(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """``pairs(a, b, shared)`` that ``links`` do not connect, with ``a_root`` and ``b_root``."""
    roots = components.components(links)
    for name in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("v").alias(name), F.col("root").alias(f"{name}_root")), name, "left")
        pairs = pairs.withColumn(f"{name}_root", F.coalesce(f"{name}_root", name))
    return pairs.where("a_root <> b_root")


def join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text)``.

    A set holds the distinct ``width``-word shingles of a text, A-Z lower-cased; a text with fewer
    words has its whole sequence as one. Sets link when ``100 * intersection >= percent * union``; a
    component is named by its smallest doc_id. Null, empty and wordless texts are linked with nothing.
    Rows of one doc_id count as linked; rows without a doc_id have no component. Texts are compared
    whole, equal sets as one. An empty table gives no rows.
    """
    common = common_tokens(docs, width).toArrow()
    blob = common["h"].to_numpy().tobytes() + common["df"].to_numpy().tobytes()
    tokens = docs.sparkSession.sparkContext.broadcast((blob, common.num_rows))
    rows = scratch.materialise(described(docs, width, percent, tokens), "join-described")
    some = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = scratch.materialise(
        some.groupBy("f", "g", "n").agg(F.min("doc_id").alias("v"), F.first("first").alias("first"), F.count("*").alias("rows")), "join-classes"
    )
    smaller = F.expr(f"({percent} * n + 99) div 100")
    inner = F.expr(f"({percent} * (({percent} * n + 99) div 100) + 99) div 100")
    need = F.least(smaller, 2 * (smaller - inner) + 1) - smaller + inner
    race = alive = classes.select("v", need.alias("need"), "first")
    for _ in range(ROUNDS):
        alive = scratch.materialise(still_alive(alive, "first"), "join-alive")
        few = joins.fits(alive.count(), BROADCAST_IDS)
        alive = race.join(joins.broadcast_if(alive, few), "v", "left_semi")
    stored = scratch.materialise(with_sets(docs, alive.select("v").distinct(), width, percent, tokens), "join-sets")
    sets = stored
    for order in ORDERS[1:]:
        alive = scratch.materialise(still_alive(sets, order), "join-alive")
        few = joins.fits(alive.count(), BROADCAST_IDS)
        sets = stored.join(joins.broadcast_if(alive, few), "v", "left_semi")
    similar = similar_sets(sets, percent)
    named = some.select("doc_id", "f", "g", "n")
    repeated = named.groupBy("doc_id").agg(F.count_distinct("f", "g", "n").alias("sets")).where("sets > 1").select("doc_id")
    keys = ["f", "g", "n"]
    of_copies = classes.select(*keys, "rows")
    same = joins.split_join(named.join(repeated, "doc_id", "left_semi"), classes.select(*keys, "v"), keys, counts=of_copies)
    same = same.select(F.col("doc_id").alias("a"), F.col("v").alias("b"))
    roots = components.components(similar.union(same))
    tokens.destroy()
    of_class = classes.select(*keys, "v").join(roots, "v", "left").select(*keys, F.coalesce("root", "v").alias("root"))
    found = joins.split_join(named, of_class, keys, counts=of_copies).select("doc_id", F.col("n").alias("n_shingles"), F.col("root").alias("component_id"))
    return found.union(rows.where("n = 0 OR doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), "doc_id"))
