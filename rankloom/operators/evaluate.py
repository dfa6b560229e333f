"""Judging hits and scoring rankings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.annotations import grade_for_topic, grade_of, topic_of, well_formed
from rankloom.plans.joins import fits, lookup_join
from rankloom.plans.scratch import materialise


def judgments(docs: DataFrame) -> DataFrame:
    """``(doc_id, topic_id, grade)`` of the well-formed annotations."""
    annotation = F.col("annotation")
    return docs.where(well_formed(annotation)).select(
        "doc_id", topic_of(annotation).alias("topic_id"), grade_of(annotation).alias("grade")
    )


def hits_with(hits: DataFrame, queries: DataFrame, docs: DataFrame, depth: int | None) -> DataFrame:
    """The first ``depth`` hits, or all, with their topic and the columns of ``docs``.

    Every hit stays, also one whose document is missing. The hits are stored and their ids copied to
    where the documents are; only the documents that are hit move.
    """
    chosen = hits if depth is None else hits.where(F.col("rank") <= depth)
    chosen = materialise(chosen.select("query_id", "doc_id", "score", "rank"), "hits")
    few, ids = fits(chosen.count()), chosen.select("doc_id")
    found = docs.join(F.broadcast(ids) if few else ids.distinct(), "doc_id", "left_semi")
    return chosen.join(queries.select("query_id", "topic_id"), "query_id").join(found, "doc_id", "left")


def judge(hits: DataFrame, queries: DataFrame, docs: DataFrame, depth: int | None = None) -> DataFrame:
    """Grade the first ``depth`` hits of each query, or all, by the documents' annotations.

    ``(query_id, doc_id, score, rank, grade)``. A hit without a judgment, or without a document, has
    grade 0.
    """
    joined = hits_with(hits, queries, docs.select("doc_id", "annotation"), depth)
    grade = F.coalesce(grade_for_topic(F.col("annotation"), F.col("topic_id")), F.lit(0))
    return joined.select("query_id", "doc_id", "score", "rank", grade.alias("grade"))


def judge_by_table(hits: DataFrame, queries: DataFrame, judged: DataFrame) -> DataFrame:
    """As :func:`judge`, with grades from a table ``(topic_id, doc_id, grade)``; 0 where missing."""
    with_topic = hits.join(queries.select("query_id", "topic_id"), "query_id")
    return lookup_join(
        with_topic, judged.select("topic_id", "doc_id", "grade"), ["topic_id", "doc_id"], "left"
    ).select(
        "query_id", "doc_id", "score", "rank", F.coalesce("grade", F.lit(0)).alias("grade")
    )


def relevance_vectors(judged: DataFrame, depth: int) -> DataFrame:
    """Grades in rank order, at most ``depth`` per query: ``(query_id, relevance)``."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", "grade")))
    return (
        judged.where(F.col("rank") <= depth)
        .groupBy("query_id")
        .agg(F.transform(pairs, lambda p: p["grade"]).alias("relevance"))
    )


def score(judged: DataFrame, queries: DataFrame, k: int = 20, first_page: int = 8) -> DataFrame:
    """All metrics per query; a query without hits scores 0 everywhere.

    ``(query_id, n_hits, n_grade_1, n_grade_2, prec, ap, dcg, ndcg, first_page_ratio)``. Average
    precision runs over the whole list and over the relevant documents in it; the ideal order is
    that of the list itself.
    """
    by_rank = Window.partitionBy("query_id").orderBy("rank")
    by_grade = Window.partitionBy("query_id").orderBy(F.col("grade").desc(), F.col("rank"))
    rank, ideal, grade = F.col("rank"), F.col("ideal"), F.col("grade")
    relevant = F.when(grade > 0, 1).otherwise(0)

    def total(value, condition):
        return F.sum(F.when(condition, value).otherwise(0.0))

    found = (
        judged.withColumn("found", F.sum(relevant).over(by_rank))
        .withColumn("ideal", F.row_number().over(by_grade))
        .groupBy("query_id")
        .agg(
            F.count("*").alias("n_hits"),
            F.count_if(grade == 1).alias("n_grade_1"),
            F.count_if(grade == 2).alias("n_grade_2"),
            (total(relevant, rank <= k) / k).alias("prec"),
            F.try_divide(total(F.col("found") / rank, grade > 0), F.sum(relevant)).alias("ap"),
            total(grade / F.log2(rank + 1.0), rank <= k).alias("dcg"),
            total(grade / F.log2(ideal + 1.0), ideal <= k).alias("best"),
            F.try_divide(total(grade, rank <= first_page), total(grade, ideal <= first_page)).alias(
                "first_page_ratio"
            ),
        )
        .withColumn("ndcg", F.try_divide("dcg", "best"))
    )
    scored = queries.select("query_id").join(found, "query_id", "left")

    def or_zero(*names):
        return [F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names]

    return scored.select(
        "query_id",
        *or_zero("n_hits", "n_grade_1", "n_grade_2"),
        *or_zero("prec", "ap", "dcg", "ndcg", "first_page_ratio"),
    )


def score_grid(
    approaches: dict[str, DataFrame],
    queries: DataFrame,
    docs: DataFrame,
    k: int = 20,
    depth: int | None = None,
) -> DataFrame:
    """Scores of every topic, query type and approach.

    ``approaches`` maps a name to its hits. All hits are judged in one pass over the documents:
    ``(topic_id, query_type, approach, prec, ap, ndcg)``. ``k`` is that of precision and NDCG;
    average precision and the ideal order run over all hits, or the first ``depth``.
    """
    tagged = [
        hits.withColumn("query_id", F.concat_ws("|", F.lit(name), "query_id"))
        for name, hits in approaches.items()
    ]
    runs = queries.withColumn(
        "approach", F.explode(F.array(*[F.lit(name) for name in approaches]))
    ).withColumn("query_id", F.concat_ws("|", "approach", "query_id"))
    scored = score(judge(reduce(DataFrame.unionByName, tagged), runs, docs, depth), runs, k)
    return scored.join(runs, "query_id").select(
        "topic_id", "query_type", "approach", "prec", "ap", "ndcg"
    )


def grid_report(grid: DataFrame) -> DataFrame:
    """Mean NDCG per approach and query type, over the number of topics."""
    n_topics = grid.agg(F.count_distinct("topic_id")).scalar()
    return grid.groupBy("approach", "query_type").agg(
        (F.sum("ndcg") / n_topics).alias("mean_ndcg")
    )
