"""Exact top-k inner products by the threshold algorithm over sorted lists, one list per dimension.

Candidates are cut into blocks, queries into chunks. A task holds one block's sorted lists and reads
them for each query of one chunk from the promising end, all lists to the same depth. A row that
turns up in any list gets its whole score. No unseen row can score more than the sum of the products
at the current depth, so reading ends when that bound lies below the k-th score so far. The blocks'
best k are merged at the end; a block and a chunk have a fixed size, however large the tables are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
CHUNK_ROWS = 2048
FIRST_DEPTH = 8
# Integer products summed as doubles are exact below this.
EXACT = float(1 << 53)


def whole_units(vector: Column, scale: int = 256) -> Column:
    """Every component as ``floor(scale * x)``; null for a vector with a null or non-finite one."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    units = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return F.when(vector.isNotNull() & finite, units)


class SortedLists:
    """A block of integer vectors with its ids and each dimension's row order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids = ids
        self.exact = len(ids) == 0 or float(np.abs(vectors.astype(np.float64)).max(initial=0)) ** 2 * vectors.shape[1] < EXACT
        self.vectors = vectors.astype(np.float64) if self.exact else vectors.astype(object)
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(vectors, self.order.astype(np.int64), axis=0)

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the block's best k, greater scores and then smaller ids first."""
        n = len(self.ids)
        wide = not self.exact or float(np.abs(query.astype(np.float64)).max(initial=0)) ** 2 * len(query) >= EXACT
        kind = object if wide else np.float64
        weights, vectors = query.astype(kind), self.vectors.astype(kind, copy=False)
        up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
        seen = self.ids == query_id
        ids, scores = np.zeros(0, np.int64), np.zeros(0, kind)
        depth, end = 0, FIRST_DEPTH
        while depth < n:
            end = min(end, n)
            reached = np.zeros(n, bool)
            reached[self.order[depth:end, up]] = True
            reached[self.order[n - end : n - depth, down]] = True
            if end == n:
                reached[:] = True  # dimensions of weight zero have no list
            new = np.flatnonzero(reached & ~seen)
            seen |= reached
            found = vectors[new] @ weights
            if len(scores) == k:
                good = found >= scores[-1]
                new, found = new[good], found[good]
            ids, scores = np.concatenate([ids, self.ids[new]]), np.concatenate([scores, found])
            if len(scores) > 4 * k:
                enough = np.partition(scores, len(scores) - k)[len(scores) - k]
                ids, scores = ids[scores >= enough], scores[scores >= enough]
            order = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[order], scores[order]
            bound = (weights[up] * self.values[end - 1, up]).sum() + (weights[down] * self.values[n - end, down]).sum()
            if len(scores) == k and scores[-1] > bound:
                break
            depth, end = end, end * 4
        return ids, scores


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), width)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k best candidates, ties to the smaller id.

    ``queries(query_id, units)`` and ``candidates(vec_id, units)`` hold integer vectors. Null ids and
    null vectors take no part, nor do candidates of another length than the query. A query is not
    compared with rows of its own id. Equal repeated queries count once, repeated candidates each.
    Sums beyond 53 bits are made with whole Python numbers and must fit into a long.
    """
    candidates = candidates.select("vec_id", "units").where("vec_id IS NOT NULL AND units IS NOT NULL")
    queries = queries.select("query_id", "units").where("query_id IS NOT NULL AND units IS NOT NULL").distinct()
    blocks = -(-candidates.count() // BLOCK_ROWS) or 1
    chunks = -(-queries.count() // CHUNK_ROWS) or 1

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = candidates.select(
        "*",
        F.size("units").alias("width"),
        F.pmod(F.xxhash64("vec_id", "units"), F.lit(blocks)).cast("int").alias("block"),
        every(chunks).alias("chunk"),
    )
    asked = queries.select(
        "*",
        F.size("units").alias("width"),
        F.pmod(F.xxhash64("query_id", "units"), F.lit(chunks)).cast("int").alias("chunk"),
        F.xxhash64("units").alias("form"),
        every(blocks).alias("block"),
    )

    def search(key: tuple, asked: pa.Table, block: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "form": [], "vec_id": [], "score": []}
        if asked.num_rows and block.num_rows:
            width = key[0].as_py()
            lists = SortedLists(block["vec_id"].to_numpy(), matrix(block["units"], width))
            wanted = matrix(asked["units"], width)
            for i, (query_id, form) in enumerate(zip(asked["query_id"].to_pylist(), asked["form"].to_pylist())):
                ids, scores = lists.best(query_id, wanted[i], k)
                out["query_id"] += [query_id] * len(ids)
                out["form"] += [form] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += [int(s) for s in scores]
        return pa.table({name: pa.array(column, pa.int64()) for name, column in out.items()})

    group = ("width", "block", "chunk")
    found = (
        asked.groupBy(*group)
        .cogroup(dealt.groupBy(*group))
        .applyInArrow(search, "query_id long, form long, vec_id long, score long")
    )
    place = Window.partitionBy("query_id", "form").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
