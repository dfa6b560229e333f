"""Relevance statistics of a corpus, and result pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.annotations import grade_for_topic, grade_of, topic_of, well_formed
from rankloom.functions.text import snippet
from rankloom.operators.evaluate import hits_with, score
from rankloom.plans.scratch import materialise


def relevance_counts(docs: DataFrame, topic_id: str | None = None) -> DataFrame:
    """Documents per topic and grade: ``(topic_id, grade, n_docs)``; malformed annotations skipped."""
    annotation = F.col("annotation")
    judged = docs.where(well_formed(annotation)).select(
        topic_of(annotation).alias("topic_id"), grade_of(annotation).alias("grade")
    )
    if topic_id is not None:
        judged = judged.where(F.col("topic_id") == topic_id)
    return judged.groupBy("topic_id", "grade").agg(F.count("*").alias("n_docs"))


def relevant_fraction(docs: DataFrame) -> DataFrame:
    """Share of relevant documents per topic, the highest first: ``(topic_id, fraction)``."""
    counts = relevance_counts(docs)
    relevant = F.sum(F.when(F.col("grade") != 0, F.col("n_docs")).otherwise(0))
    return (
        counts.groupBy("topic_id")
        .agg((relevant / F.sum("n_docs")).alias("fraction"))
        .orderBy(F.col("fraction").desc(), "topic_id")
    )


def document(docs: DataFrame, doc_id: int | str) -> DataFrame:
    """One document by id; the predicate reaches the file scan."""
    return docs.where(F.col("doc_id") == doc_id)


def search_fields(
    queries: DataFrame, topic_ids: list[str], special: str = "summary", usual: str = "content"
) -> DataFrame:
    """Add the ``field`` to search: ``special`` for the listed topics, ``usual`` for the others."""
    field = F.when(F.col("topic_id").isin(topic_ids), special).otherwise(usual)
    return queries.withColumn("field", field)


def tokenizer_field(tokenizer: str = "") -> str:
    """The analysed field that goes with a tokenizer name; the plain content without one."""
    fields = {"": "content", "classic": "classic_content", "whitespace": "whitespace_content"}
    if tokenizer not in fields:
        raise ValueError(f"no field for tokenizer {tokenizer!r}")
    return fields[tokenizer]


def enriched_hits(hits: DataFrame, queries: DataFrame, docs: DataFrame, depth: int) -> DataFrame:
    """Hits with title, snippet and grade, in one pass over the documents.

    ``(query_id, doc_id, score, rank, title, snippet, grade)`` for the first ``depth`` hits. A hit
    whose document is missing has neither title nor snippet, and grade 0.
    """
    shown = docs.select("doc_id", "title", snippet(F.col("content")).alias("snippet"), "annotation")
    grade = F.coalesce(grade_for_topic(F.col("annotation"), F.col("topic_id")), F.lit(0))
    return hits_with(hits, queries, shown, depth).select(
        "query_id", "doc_id", "score", "rank", "title", "snippet", grade.alias("grade")
    )


def page(hits: DataFrame, number: int, size: int = 8) -> DataFrame:
    """Page ``number`` of each query's hits, from 0."""
    return hits.where(F.col("rank").between(number * size + 1, (number + 1) * size))


def result_counts(hits: DataFrame, size: int = 8) -> DataFrame:
    """Number of hits and of the last page per query: ``(query_id, n_hits, max_pages)``.

    Takes ranked hits, or the unranked scores if all matches are to be counted.
    """
    return with_pages(hits.groupBy("query_id").agg(F.count("*").alias("n_hits")), size)


def with_pages(counts: DataFrame, size: int = 8) -> DataFrame:
    """Add ``max_pages``, the number of the last page, to ``(query_id, n_hits)``."""
    return counts.withColumn("max_pages", F.floor(F.col("n_hits") / size))


def result_page(hits: DataFrame, queries: DataFrame, docs: DataFrame, depth: int = 16, size: int = 8) -> DataFrame:
    """All that a result page shows, from one judged table.

    The first ``depth`` hits with title, snippet, grade and page number, and beside each hit its
    query's number of hits, last page and metrics at ``size``. The hits may come from several fields.
    """
    shown = materialise(enriched_hits(hits, queries, docs, depth), "page")
    page_no = F.floor((F.col("rank") - 1) / size)
    return shown.withColumn("page", page_no).join(with_pages(score(shown, queries, size), size), "query_id")
