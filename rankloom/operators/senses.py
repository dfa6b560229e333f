"""Query expansion with word senses."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.text import cased_words, spaced, valid_lemma
from rankloom.functions.vectors import cosine
from rankloom.operators.pooling import mean_pool
from rankloom.plans.joins import lookup_join
from rankloom.plans.ranking import rounded
from rankloom.plans.scratch import materialise


class SenseStrategy(Enum):
    """How a word's sense is chosen: the first, by definition overlap, or by vector similarity."""

    FIRST = "FIRST"
    LESK = "LESK"
    VECTOR = "VECTOR"


def content_tokens(queries: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Query words that are no stop words, case kept: ``(query_id, pos, token)``."""
    words = queries.select(
        "query_id", F.posexplode(cased_words(F.col("query_text"))).alias("pos", "token")
    )
    return lookup_join(
        words, stopwords.select(F.col("term").alias("token")), ["token"], "left_anti", "query_id"
    )


def token_senses(tokens: DataFrame, senses: DataFrame) -> DataFrame:
    """Every sense of every token; the lookup ignores case. ``senses(term, sense_rank, sense_id)``."""
    return lookup_join(
        tokens.withColumn("term", F.lower("token")),
        senses.select("term", "sense_rank", "sense_id"),
        ["term"],
        "inner",
        "query_id",
    )


def _best_sense(candidates: DataFrame, value) -> DataFrame:
    """Highest value per token; the earlier sense wins a tie."""
    order = F.struct(value.alias("value"), (-F.col("sense_rank")).alias("earlier"))
    return candidates.groupBy("query_id", "pos", "token").agg(
        F.max_by("sense_id", order).alias("sense_id")
    )


def first_senses(candidates: DataFrame) -> DataFrame:
    return _best_sense(candidates, F.lit(0))


def lesk_senses(candidates: DataFrame, queries: DataFrame, definitions: DataFrame) -> DataFrame:
    """The sense whose definition shares most words with the query; ``definitions(sense_id, definition)``."""
    context = queries.select("query_id", cased_words(F.col("query_text")).alias("context"))
    with_text = lookup_join(candidates, definitions, ["sense_id"], "left", "query_id").join(
        context, "query_id"
    )
    defined = F.split(F.coalesce("definition", F.lit("")), " ")
    return _best_sense(with_text, F.size(F.array_intersect("context", defined)))


def sense_texts(lemmas: DataFrame, definitions: DataFrame) -> DataFrame:
    """Lemma names and definition of each sense as one text: ``(sense_id, text)``."""
    names = lemmas.groupBy("sense_id").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("lemma_no", "lemma"))),
                lambda entry: spaced(entry["lemma"]),
            ),
            " ",
        ).alias("names")
    )
    return names.join(definitions, "sense_id", "full").select(
        "sense_id", F.concat_ws(" ", "names", "definition").alias("text")
    )


def vector_senses(
    candidates: DataFrame, query_vectors: DataFrame, sense_vectors: DataFrame
) -> DataFrame:
    """The sense whose vector is most similar to the query's; ``sense_vectors(sense_id, vec)``."""
    with_sense = lookup_join(
        candidates,
        sense_vectors.select("sense_id", F.col("vec").alias("sense_vec")),
        ["sense_id"],
        "left",
        "query_id",
    )
    both = with_sense.join(
        query_vectors.select("query_id", F.col("vec").alias("query_vec")), "query_id", "left"
    )
    similarity = rounded(cosine(F.col("query_vec"), F.col("sense_vec")))
    return _best_sense(both, F.coalesce(similarity, F.lit(-2.0)))


def sense_lemmas(chosen: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Valid lemmas of the chosen senses: ``(query_id, pos, token, sense_id, lemma_no, lemma)``."""
    found = lookup_join(chosen, lemmas, ["sense_id"], "inner", "query_id")
    return found.where(valid_lemma(F.col("lemma"))).withColumn("lemma", spaced(F.col("lemma")))


def append_terms(queries: DataFrame, terms: DataFrame) -> DataFrame:
    """Append ``terms(query_id, place, term)`` to the query texts, in order of place."""
    added = terms.groupBy("query_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", "term"))), lambda entry: entry["term"]
        ).alias("added")
    )
    appended = F.concat_ws(
        " ", "query_text", F.coalesce(F.array_join("added", " "), F.lit(""))
    )
    return queries.join(added, "query_id", "left").select(
        *[c for c in queries.columns if c != "query_text"], appended.alias("query_text")
    )


def expand_senses(
    queries: DataFrame,
    senses: DataFrame,
    lemmas: DataFrame,
    definitions: DataFrame,
    stopwords: DataFrame,
    strategy: SenseStrategy = SenseStrategy.FIRST,
    word_vectors: DataFrame | None = None,
    dims: int = 300,
) -> DataFrame:
    """Append the lemmas of each content word's sense to the query.

    Senses are embedded once each, however many queries use them. The vector strategy needs
    ``word_vectors``; query and sense vectors are means of all their word vectors.
    """
    candidates = token_senses(content_tokens(queries, stopwords), senses)
    if strategy is SenseStrategy.FIRST:
        chosen = first_senses(candidates)
    elif strategy is SenseStrategy.LESK:
        chosen = lesk_senses(candidates, queries, definitions)
    else:
        if word_vectors is None:
            raise ValueError("the vector strategy needs word vectors")
        chosen = vector_senses(
            candidates,
            mean_pool(queries, word_vectors, stopwords, dims, "query_id", "query_text"),
            # Stored, because the join measures them before it reads them.
            materialise(
                mean_pool(
                    sense_texts(lemmas, definitions), word_vectors, stopwords, dims, "sense_id", "text"
                ),
                "sense-vectors",
            ),
        )
    found = sense_lemmas(chosen, lemmas)
    return append_terms(
        queries,
        found.select(
            "query_id", F.struct("pos", "lemma_no").alias("place"), F.col("lemma").alias("term")
        ),
    )
