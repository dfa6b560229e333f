"""The corpus pipeline: stages over ``documents``, each from one operator of ``rankloom.llm``.

Every stage works on all documents that its predecessor kept, and returns the columns of
``documents``; the last one returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import ngram_rules, packing, secret_scan, soft_mixing, tensored_minhash
from rankloom.llm.queries import domain_labels, table
from rankloom.plans import joins, scratch

# Ids of dropped documents that may be broadcast, at eight bytes each.
BROADCAST_IDS = 4_000_000

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
# Token shares by domain. Documents of the anchor domain all stay.
WEIGHTS = {"clean": 0.90, "low": 0.09, "toxic": 0.01}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what passes the rules and the likelihood ratio; trusted are labelled good documents."""
    model = ngram_rules.fit(docs, table(spark, sf_dir, "labels").where("quality = 1 AND (toxic IS NULL OR toxic = 0)"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return ngram_rules.judge(rows, model, keep=("row",)).where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: five-word shingles, similarity of 0.8 or more.

    Rows of one doc_id are one document, and stay or go together.
    """
    found = tensored_minhash.near_duplicates(docs, width=5, percent=80)
    dropped = scratch.materialise(found.where("NOT kept").select("doc_id").distinct(), "dropped")
    few = joins.fits(dropped.count(), BROADCAST_IDS)
    first = docs.join(joins.broadcast_if(dropped, few), "doc_id", "left_anti")
    return first.select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; ``n_chars`` follows the text."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Thin low and toxic documents until the token shares are near the targets."""
    return soft_mixing.resample(docs, domain_labels(spark, sf_dir), WEIGHTS, anchor="clean")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("secret scans", secrets),
    ("mixing", mixing),
    ("packing", pack),
]

# The hashed n-grams, the classifier and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored as Parquet and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
