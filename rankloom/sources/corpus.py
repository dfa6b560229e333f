"""JSON-lines corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Vectors come flat (one vector) or nested (one per chunk), so they are read as JSON text and
# brought to one shape afterwards.
CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("content_str", T.StringType()),
        T.StructField("annotation", T.StringType()),
        T.StructField("published_date", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("summary_vector", T.StringType()),
        T.StructField("ft_vector", T.StringType()),
    ]
)


def nested_vectors(json_text: Column) -> Column:
    """A flat or nested JSON array of numbers as ``array<array<double>>``."""
    nested = F.from_json(json_text, "array<array<double>>")
    flat = F.from_json(json_text, "array<double>")
    return (
        F.when(json_text.rlike(r"^\s*\[\s*\["), nested).when(json_text.isNotNull(), F.array(flat))
    )


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON line; the text is ``content`` or, where that is missing, ``content_str``."""
    raw = spark.read.schema(CORPUS_SCHEMA).json(path)
    return raw.select(
        "doc_id",
        "title",
        "author",
        F.coalesce("content", "content_str").alias("content"),
        "annotation",
        "published_date",
        "summary",
        nested_vectors(F.col("summary_vector")).alias("summary_vector"),
        F.from_json("ft_vector", "array<double>").alias("ft_vector"),
    )


def write_corpus(docs: DataFrame, path: str) -> None:
    """One JSON object per line; an existing output is replaced."""
    docs.write.mode("overwrite").json(path)
