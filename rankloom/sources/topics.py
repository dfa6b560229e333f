"""Topics: several ``<top>`` elements in one file, separated by blank lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERY_TYPES = ("title", "description", "narrative")


def _last_line(text: Column) -> Column:
    return F.element_at(F.split(F.trim(F.regexp_replace(text, r"^\s+|\s+$", "")), "\n"), -1)


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """``(topic_id, title, description, narrative)``, by tag; the last line of each element counts."""
    blocks = spark.read.option("lineSep", "\n\n").text(path)
    parsed = blocks.where(F.trim("value") != "").select(
        F.from_xml("value", "num string, title string, desc string, narr string").alias("top")
    )
    return parsed.select(
        F.trim(F.element_at(F.split("top.num", ":"), -1)).alias("topic_id"),
        _last_line(F.col("top.title")).alias("title"),
        _last_line(F.col("top.desc")).alias("description"),
        _last_line(F.col("top.narr")).alias("narrative"),
    )


def select_topics(topics: DataFrame, topic_ids: list[str]) -> DataFrame:
    """Only the chosen topics, as named fields."""
    return topics.where(F.col("topic_id").isin(topic_ids)).select("topic_id", *QUERY_TYPES)


def topic_queries(topics: DataFrame) -> DataFrame:
    """One row per topic and query type: ``(query_id, topic_id, query_type, query_text)``."""
    return topics.unpivot("topic_id", list(QUERY_TYPES), "query_type", "query_text").select(
        F.concat_ws("-", "topic_id", "query_type").alias("query_id"),
        "topic_id",
        "query_type",
        "query_text",
    )


def query_or_topic_text(requests: DataFrame, topics: DataFrame) -> DataFrame:
    """Fill an empty user query with the topic's text of the wanted type.

    ``requests(query_id, topic_id, query_type, query_text)``.
    """
    texts = topic_queries(topics).select(
        "topic_id", "query_type", F.col("query_text").alias("topic_text")
    )
    return requests.join(texts, ["topic_id", "query_type"], "left").select(
        "query_id",
        "topic_id",
        "query_type",
        F.coalesce(F.nullif("query_text", F.lit("")), "topic_text").alias("query_text"),
    )
