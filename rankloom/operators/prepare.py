"""Corpus preparation: filtering, reshaping and completing raw documents."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.annotations import has_topic_prefix
from rankloom.operators.pooling import encode
from rankloom.operators.summarize import sentences


def take_topics(docs: DataFrame, prefixes: list[str]) -> DataFrame:
    """Documents whose annotation starts with one of the topic prefixes."""
    return docs.where(has_topic_prefix(F.col("annotation"), prefixes))


def backfill_content(docs: DataFrame, originals: DataFrame) -> DataFrame:
    """Add ``content`` from ``originals(doc_id, content_str, line_no)``.

    Left outer: NULL where there is no original; of several originals the last line wins.
    """
    last = originals.groupBy("doc_id").agg(F.max_by("content_str", "line_no").alias("content"))
    return docs.join(last, "doc_id", "left")


def prepared_records(docs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Documents reshaped for the index, with their chunk vectors in order.

    ``docs`` has the joined summaries; ``vectors(doc_id, chunk_no, vec)``.
    """
    nested = vectors.groupBy("doc_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("chunk_no", "vec"))), lambda c: c["vec"]
        ).alias("summary_vector")
    )
    return docs.join(nested, "doc_id", "left").select(
        "title",
        "doc_id",
        "content",
        "author",
        "annotation",
        "published_date",
        "summary",
        "summary_vector",
    )


def summary_sentences(docs: DataFrame) -> DataFrame:
    """Sentences of each summary, which are embedded one by one: ``(doc_id, sentence_no, sentence)``."""
    return docs.select(
        "doc_id", F.posexplode(sentences(F.col("summary"))).alias("sentence_no", "sentence")
    )


def encoded_summaries(
    docs: DataFrame,
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
    batch_size: int = 256,
) -> DataFrame:
    """Add ``summary_vector``: the vector of each sentence of ``summary``, in order.

    Sentences are encoded in batches across documents, then gathered by document; the other columns
    of ``docs`` wait for them in a join on ``doc_id``.
    """
    encoded = encode(summary_sentences(docs), make_predict_fn, "sentence", batch_size)
    vectors = encoded.select("doc_id", F.col("sentence_no").alias("chunk_no"), "vec").groupBy("doc_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("chunk_no", "vec"))), lambda c: c["vec"]
        ).alias("summary_vector")
    )
    return docs.join(vectors, "doc_id", "left")
