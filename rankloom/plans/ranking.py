"""Ranked lists: ``hits(query_id, doc_id, score, rank)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Scores are rounded before they are compared, so that the order of a distributed sum cannot
# change a rank when a task is run again.
SCORE_DIGITS = 6


def rounded(score: Column, digits: int = SCORE_DIGITS) -> Column:
    return F.round(score, digits)


def best_first() -> list[Column]:
    """Score descending; ties by the id as a string, descending."""
    return [F.col("score").desc_nulls_last(), F.col("doc_id").cast("string").desc()]


def ranked(scored: DataFrame, k: int | None = None, *keep: str) -> DataFrame:
    """Rank ``(query_id, doc_id, score)`` within each query and keep the first ``k``.

    The columns ``keep`` stay, too.

    With ``k`` the plan holds a WindowGroupLimit before the shuffle, so each task passes on at most
    ``k`` rows per query.
    """
    window = Window.partitionBy("query_id").orderBy(*best_first())
    hits = scored.select("query_id", *keep, "doc_id", "score").withColumn(
        "rank", F.row_number().over(window)
    )
    return hits if k is None else hits.where(F.col("rank") <= k)
