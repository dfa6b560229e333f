"""Report files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.annotations import grade_of, topic_of, well_formed


def _write_tsv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_expanded_queries(queries: DataFrame, path: str) -> None:
    """``topic, title, narrative, description``, tab-separated, one row per topic."""
    by_topic = queries.groupBy("topic_id").pivot(
        "query_type", ["title", "narrative", "description"]
    )
    _write_tsv(
        by_topic.agg(F.first("query_text")).withColumnRenamed("topic_id", "topic"), path
    )


def write_scores(scores: DataFrame, path: str) -> None:
    """``Topic, Query.type, Approach, precision, Avg.Precision, NDCG``, tab-separated."""
    _write_tsv(
        scores.select(
            F.col("topic_id").alias("Topic"),
            F.col("query_type").alias("Query.type"),
            F.col("approach").alias("Approach"),
            F.col("prec").alias("precision"),
            F.col("ap").alias("Avg.Precision"),
            F.col("ndcg").alias("NDCG"),
        ),
        path,
    )


def texts_by_grade(docs: DataFrame, topic_id: str) -> DataFrame:
    """``(grade, content)`` of one topic's judged documents."""
    annotation = F.col("annotation")
    return docs.where(well_formed(annotation) & (topic_of(annotation) == topic_id)).select(
        grade_of(annotation).alias("grade"), "content"
    )


def write_texts_by_grade(docs: DataFrame, path: str, topic_id: str) -> None:
    """The texts of one topic's documents, in one folder per grade, separated by blank lines."""
    writer = texts_by_grade(docs, topic_id).write.mode("overwrite").partitionBy("grade")
    writer.option("lineSep", "\n\n").text(path)
