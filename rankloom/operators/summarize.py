"""Chunking and summarising documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import count_terms, standard_terms
from rankloom.operators.tfidf import fit_tfidf, term_rows, with_idf
from rankloom.plans.joins import small_table
from rankloom.plans.ranking import rounded
from rankloom.plans.scratch import materialise


def chunks_of(text: Column, k: int = 1024, keep_empty_tail: bool = True) -> Column:
    """The text in pieces of ``k`` characters.

    A text whose length is a multiple of ``k`` ends in an empty piece, unless ``keep_empty_tail``
    is off; an empty text is one empty piece in either case.
    """
    length = F.length(text)
    last = F.floor(length / k).cast("int")
    if not keep_empty_tail:
        last = F.greatest(F.ceil(length / k).cast("int") - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(text, i * k + 1, F.lit(k))
    )


def split_chunks(
    docs: DataFrame, k: int = 1024, keep_empty_tail: bool = True, text: str = "content"
) -> DataFrame:
    """``(doc_id, chunk_no, chunk)``; a NULL text counts as empty."""
    pieces = chunks_of(F.coalesce(text, F.lit("")), k, keep_empty_tail)
    return docs.select("doc_id", F.posexplode(pieces).alias("chunk_no", "chunk"))


def sentences(text: Column) -> Column:
    """Split at full stops; the empty tail is kept."""
    return F.split(text, r"\.")


def truncated(text: Column, k: int = 1024) -> Column:
    return F.substring(text, 1, k)


def sentence_weights(chunks: DataFrame, idf: DataFrame) -> DataFrame:
    """Mean tf-idf weight of each sentence: ``(doc_id, chunk_no, sentence_no, weight)``.

    ``idf(term, df, idf)``; ``df`` tells which words are common enough to be broadcast if not all can be.
    """
    keys = ["doc_id", "chunk_no", "sentence_no"]
    tokens = chunks.select(
        "doc_id", "chunk_no", F.posexplode(sentences(F.col("chunk"))).alias("sentence_no", "s")
    ).select(*keys, standard_terms(F.col("s")).alias("tokens"))
    terms = count_terms(tokens, keys)
    idf = materialise(idf.select("term", "df", "idf"), "idf")
    values = idf.select("term", "idf")
    if small_table(values):
        parts = [terms.join(F.broadcast(values), "term")]
    else:
        parts = with_idf(terms, idf, ["term"], F.struct(*keys))
    # Beyond the broadcast limit only the sums of the sentences move, and the rows of rare words.
    total, n_tokens = F.sum(F.col("tf") * F.col("idf")).alias("total"), F.first("n_tokens").alias("n_tokens")
    sums = reduce(DataFrame.unionByName, [part.groupBy(*keys).agg(total, n_tokens) for part in parts])
    if len(parts) > 1:
        sums = sums.groupBy(*keys).agg(F.sum("total").alias("total"), n_tokens)
    return sums.select(*keys, rounded(F.col("total") / F.col("n_tokens")).alias("weight"))


def extract_summaries(chunks: DataFrame, idf: DataFrame) -> DataFrame:
    """The weightiest sentence of each chunk, trimmed; empty for a chunk without words.

    ``(doc_id, chunk_no, summary)``; the earlier sentence wins a tie.
    """
    order = F.struct("weight", (-F.col("sentence_no")).alias("earlier"))
    best = (
        sentence_weights(chunks, idf)
        .groupBy("doc_id", "chunk_no")
        .agg(F.max_by("sentence_no", order).alias("sentence_no"))
    )
    chosen = F.get(sentences(F.col("chunk")), F.col("sentence_no"))
    trimmed = F.regexp_replace(chosen, r"^\s+|\s+$", "")
    return chunks.join(best, ["doc_id", "chunk_no"], "left").select(
        "doc_id", "chunk_no", F.coalesce(trimmed, F.lit("")).alias("summary")
    )


def model_summaries(
    chunks: DataFrame,
    make_summarizer: Callable[[], Callable[[list[str], int, int], list[str]]],
    max_length: int = 150,
    min_length: int = 2,
    batch_size: int = 64,
) -> DataFrame:
    """``(doc_id, chunk_no, summary)`` by a user's model; the summary of a NULL chunk is NULL.

    ``make_summarizer`` loads the model once per task and returns a function of
    ``(texts, max_length, min_length)``, which is called with lists of at most ``batch_size`` texts.
    """

    @F.pandas_udf("string")
    def summarise(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        summarizer = make_summarizer()
        for texts in batches:
            known = texts.dropna()
            made: list[str] = []
            for start in range(0, len(known), batch_size):
                made += summarizer(known.iloc[start : start + batch_size].tolist(), max_length, min_length)
            yield pd.Series(made, index=known.index, dtype=object).reindex(texts.index)

    return chunks.select("doc_id", "chunk_no", summarise("chunk").alias("summary"))


def join_summaries(summaries: DataFrame) -> DataFrame:
    """Chunk summaries of each document, in order: ``(doc_id, summary, summary_chunks)``."""
    pieces = F.transform(
        F.array_sort(F.collect_list(F.struct("chunk_no", "summary"))), lambda p: p["summary"]
    )
    return (
        summaries.groupBy("doc_id")
        .agg(pieces.alias("summary_chunks"))
        .select("doc_id", F.array_join("summary_chunks", " ").alias("summary"), "summary_chunks")
    )


def summarize(
    docs: DataFrame,
    make_summarizer: Callable[[], Callable[[list[str], int, int], list[str]]] | None = None,
    k: int = 1024,
    idf: DataFrame | None = None,
) -> DataFrame:
    """Summary of each document: chunk, summarise each chunk, join.

    Without a model each chunk gives its sentence of highest mean tf-idf weight, with document
    frequencies of the whole corpus: those of ``idf(term, df, idf)`` if they are known already.
    """
    chunks = split_chunks(docs, k)
    if make_summarizer is not None:
        return join_summaries(model_summaries(chunks, make_summarizer))
    idf = fit_tfidf(term_rows(docs), docs) if idf is None else idf
    return join_summaries(extract_summaries(chunks, idf))
