"""Knowledge-graph tables as tab-separated files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

INSTANCE_OF = "entity string, class string"
SUBCLASS_OF = "class string, parent string"
LABELS = "entity string, label string, description string"


def read_triples(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One triple table; ``schema`` is one of the constants of this module."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)


def write_triples(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
