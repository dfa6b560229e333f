"""Word vectors in the usual text form: a header line, then a word and its numbers per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(term, vec)``. The header has two fields and is dropped by that."""
    fields = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f"))
    return fields.where(F.size("f") > 2).select(
        F.get("f", F.lit(0)).alias("term"),
        F.slice("f", 2, F.size("f") - 1).cast("array<double>").alias("vec"),
    )
