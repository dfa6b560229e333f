"""Encoding texts as vectors: pooled word vectors, or a model supplied by the user."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions.text import normalized_terms, term_counts
from rankloom.functions.vectors import zeros
from rankloom.plans.joins import lookup_join, small_table


def mean_pool(
    texts: DataFrame,
    word_vectors: DataFrame,
    stopwords: DataFrame,
    dims: int,
    key: str | list[str] = "doc_id",
    text: str = "content",
) -> DataFrame:
    """Mean word vector of each text: ``(key, vec)``.

    Tokens are normalised, stop words dropped; a word without a vector counts as the zero vector,
    and a text without valid tokens gets the zero vector.
    """
    keys = [key] if isinstance(key, str) else key
    tokens = texts.select(*keys, normalized_terms(F.lit(""), F.col(text)).alias("tokens"))
    return pool_terms(term_counts(tokens, keys).select(*keys, "terms"), word_vectors, stopwords, dims, keys)


# Known words that are summed at a time, in a worker.
SUMMED_AT_ONCE = 1 << 16


def pool_terms(
    rows: DataFrame, word_vectors: DataFrame, stopwords: DataFrame, dims: int, keys: list[str]
) -> DataFrame:
    """As :func:`mean_pool`, from ``(*keys, terms)``, where ``terms`` is an array of ``(term, tf)``.

    Texts stay whole in their rows: the words' vectors are looked up and summed in the worker that
    holds the text, without a shuffle and for the known words only. That needs the vectors in every
    worker; beyond the broadcast limit the terms are joined with their vectors instead.
    """
    vectors = word_vectors.select("term", "vec")
    stops = stopwords.select("term").distinct()
    if not (small_table(vectors) and small_table(stops)):
        return _pool_joined(rows, vectors, stops, dims, keys)
    stop_words = stops.toArrow()["term"].combine_chunks()
    table = vectors.toArrow()
    table = table.filter(pc.invert(pc.is_in(table["term"], stop_words)))
    matrix = pc.list_flatten(table["vec"]).to_numpy().astype(np.float64).reshape(-1, dims)
    known = pa.concat_arrays([table["term"].combine_chunks(), stop_words])
    held = rows.sparkSession.sparkContext.broadcast((known, matrix))

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, matrix = held.value
        for batch in batches:
            lists = batch.column("terms")
            entries = lists.flatten()
            row = pc.list_parent_indices(lists).to_numpy()
            place = pc.fill_null(pc.index_in(entries.field("term"), words), -1).to_numpy()
            tf = entries.field("tf").to_numpy().astype(np.float64)
            valid = place < len(matrix)
            n = np.bincount(row[valid], tf[valid], batch.num_rows)
            sums = np.zeros((batch.num_rows, dims))
            some = np.flatnonzero(valid & (place >= 0))
            for at in range(0, len(some), SUMMED_AT_ONCE):
                part = some[at : at + SUMMED_AT_ONCE]
                first = np.flatnonzero(np.append(True, np.diff(row[part]) != 0))
                sums[row[part[first]]] += np.add.reduceat(matrix[place[part]] * tf[part, None], first)
            means = sums / np.maximum(n, 1)[:, None]
            edges = np.arange(batch.num_rows + 1, dtype=np.int32) * dims
            vec = pa.ListArray.from_arrays(pa.array(edges), pa.array(means.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.select(keys).columns, vec], [*keys, "vec"])

    fields = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return rows.select(*keys, "terms").mapInArrow(pooled, f"{fields}, vec array<double>")


def _pool_joined(rows: DataFrame, vectors: DataFrame, stops: DataFrame, dims: int, keys: list[str]) -> DataFrame:
    """:func:`pool_terms` for vocabularies of any size: two joins by term, frequent terms in pieces."""
    spread_by = F.struct(*keys)
    terms = rows.select(*keys, F.inline_outer("terms"))
    flagged = lookup_join(terms, stops.withColumn("is_stop", F.lit(True)), ["term"], "left", spread_by=spread_by)
    valid = F.col("term").isNotNull() & F.col("is_stop").isNull()
    counted = flagged.select(*keys, F.when(valid, F.col("term")).alias("term"), F.when(valid, F.col("tf")).alias("n"))
    whole = counted.groupBy(*keys).agg(F.greatest(F.coalesce(F.sum("n"), F.lit(0)), F.lit(1)).alias("n_words"))
    # Only known words reach the sum.
    known = lookup_join(counted.where("term IS NOT NULL"), vectors, ["term"], "inner", spread_by=spread_by)
    total = Summarizer.sum(array_to_vector(F.transform("vec", lambda x: x.cast("double") * F.col("n"))))
    sums = known.groupBy(*keys).agg(vector_to_array(total).alias("total"))
    mean = F.transform(F.coalesce("total", zeros(dims)), lambda x: x / F.col("n_words"))
    return whole.join(sums, keys, "left").select(*keys, mean.alias("vec"))


def encode(
    texts: DataFrame,
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
    text: str = "text",
    batch_size: int = 256,
) -> DataFrame:
    """Add ``vec``, the vector of a user's model for each text.

    ``make_predict_fn`` loads the model once per Python worker and returns a function from an array
    of texts to a matrix with one row per text; it is called in batches.
    """
    predict = predict_batch_udf(
        make_predict_fn, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size
    )
    return texts.withColumn("vec", predict(F.col(text)))


def max_pool(pairs: DataFrame, similarity: Column) -> DataFrame:
    """Best similarity per query and document over the document's chunks."""
    return pairs.groupBy("query_id", "doc_id").agg(F.max(similarity).alias("best"))
