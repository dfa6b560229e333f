"""Ranking metrics on a relevance vector: an ``array<int>`` of grades in rank order.

For whole result tables use :mod:`rankloom.operators.evaluate`, which needs no arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _top(relevance: Column, k: int) -> Column:
    return F.slice(relevance, 1, k)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def precision(relevance: Column, k: int = 20) -> Column:
    """Relevant items among the first ``k``, over ``k`` even if the list is shorter."""
    return F.size(F.filter(_top(relevance, k), lambda g: g > 0)) / F.lit(float(k))


def average_precision(relevance: Column) -> Column:
    """Mean of the precision at each relevant rank; over the relevant items in the list."""
    state = F.aggregate(
        relevance,
        F.struct(
            F.lit(0).alias("rank"), F.lit(0).alias("found"), F.lit(0.0).cast("double").alias("total")
        ),
        lambda s, g: F.struct(
            (s["rank"] + 1).alias("rank"),
            (s["found"] + F.when(g > 0, 1).otherwise(0)).alias("found"),
            (
                s["total"] + F.when(g > 0, (s["found"] + 1) / (s["rank"] + 1)).otherwise(F.lit(0.0))
            ).alias("total"),
        ),
        lambda s: F.coalesce(F.try_divide(s["total"], s["found"]), F.lit(0.0)),
    )
    return state


def dcg(relevance: Column, k: int = 20) -> Column:
    """Sum of ``grade / log2(rank + 1)`` over the first ``k``."""
    return _total(F.transform(_top(relevance, k), lambda g, i: g / F.log2((i + 2).cast("double"))))


def ndcg(relevance: Column, k: int = 20) -> Column:
    """DCG over the DCG of the same list in the best order; 0 if that is 0."""
    ideal = dcg(F.sort_array(relevance, asc=False), k)
    return F.coalesce(F.try_divide(dcg(relevance, k), ideal), F.lit(0.0))


def first_page_ratio(relevance: Column, n: int = 8) -> Column:
    """Sum of the first ``n`` grades over the sum of the best ``n``."""
    best = _total(_top(F.sort_array(relevance, asc=False), n))
    return F.coalesce(F.try_divide(_total(_top(relevance, n)), best), F.lit(0.0))


def score_bundle(relevance: Column, k: int = 20) -> Column:
    """``struct(ap, prec, ndcg)``."""
    return F.struct(
        average_precision(relevance).alias("ap"),
        precision(relevance, k).alias("prec"),
        ndcg(relevance, k).alias("ndcg"),
    )
