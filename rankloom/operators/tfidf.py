"""Tf-idf weights, keywords and keyword vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.annotations import grade_of, topic_of
from rankloom.functions.text import count_terms, open_terms, standard_terms, term_counts
from rankloom.functions.vectors import cosine, scaled_sum, zeros
from rankloom.operators.index import Index
from rankloom.operators.phrases import noun_pairs, phrase_terms
from rankloom.operators.pooling import mean_pool, pool_terms
from rankloom.operators.rerank import cosine_rerank
from rankloom.plans.joins import broadcast_if, fits, fitting_from, small_table, split_join
from rankloom.plans.ranking import ranked, rounded
from rankloom.plans.scratch import materialise


def fit_corpus(docs: DataFrame, topic_id: str, limit: int = 33) -> DataFrame:
    """Documents judged for a topic, the best grades first, at most ``limit``."""
    annotation = F.col("annotation")
    return (
        docs.where(topic_of(annotation) == topic_id)
        .withColumn("grade", grade_of(annotation))
        .orderBy(F.col("grade").desc(), "doc_id")
        .limit(limit)
    )


def term_rows(texts: DataFrame, key: str = "doc_id", text: str = "content") -> DataFrame:
    """``(key, term, tf)`` of the standard terms."""
    tokens = texts.select(key, standard_terms(F.col(text)).alias("tokens"))
    return count_terms(tokens, [key]).select(key, "term", "tf")


def fit_tfidf(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """Document frequency and smoothed idf, ``ln((1 + n) / (1 + df)) + 1``: ``(term, df, idf)``.

    ``terms`` has one row per text and distinct term; ``texts`` is what they were taken from, empty
    texts included.
    """
    n_texts = texts.agg(F.count("*")).scalar()
    counted = terms.groupBy("term").agg(F.count("*").alias("df"))
    return counted.select(
        "term", "df", (F.log((n_texts + 1) / (F.col("df") + 1)) + 1.0).alias("idf")
    )


def index_model(index: Index, field: str = "content") -> DataFrame:
    """As :func:`fit_tfidf`, from the statistics of a stored index: no text is read or counted again."""
    n_texts = index.forward.where(F.col("field") == field).agg(F.count("*")).scalar()
    idf = (F.log((n_texts + 1) / (F.col("df") + 1)) + 1.0).alias("idf")
    return index.term_stats.where(F.col("field") == field).select("term", "df", idf)


def forward_terms(index: Index, field: str = "content") -> DataFrame:
    """``(doc_id, terms)``: the stored terms of each document, an array of ``(term, tf)``."""
    return index.forward.where(F.col("field") == field).select("doc_id", "terms")


def term_arrays(texts: DataFrame, key: str = "doc_id", text: str = "content") -> DataFrame:
    """``(key, terms)``: the standard terms of each text, an array of ``(term, tf)``."""
    tokens = texts.select(key, standard_terms(F.col(text)).alias("tokens"))
    return term_counts(tokens, [key]).select(key, "terms")


def weighted_texts(
    rows: DataFrame, idf: DataFrame, keys: list[str], model: list[str] | None = None
) -> DataFrame:
    """Weights of each text in its row: ``(*keys, weights)``, an array of ``(weight, term)``, heaviest first.

    ``rows(*keys, terms)`` with ``terms`` an array of ``(term, tf)``; ``idf(term, df, idf)``. Terms that
    the fit has not seen are dropped, and so is a text without known terms. Tf times idf is scaled to
    unit length and ordered inside the row (ties by term, descending), so the term rows are exchanged
    once, to meet their text again, and not at all if ``rows`` are bucketed by the key. The vocabulary
    is as large as the corpus makes it: beyond the broadcast limit its most common words, by ``df``, are
    broadcast, and only the rows of the others are shuffled (:func:`with_idf`).

    With ``model``, columns of the keys, every value of them has an idf table of its own:
    ``idf(*model, term, df, idf)``.
    """
    on = [*(model or []), "term"]
    idf = materialise(idf.select(*on, "df", "idf"), "idf")
    values = idf.select(*on, "idf")
    if small_table(values):
        return _scaled(_raw_weights(open_terms(rows, keys).join(F.broadcast(values), on), keys), keys)
    named = F.lit(True)
    for key in keys:
        named &= F.col(key).isNotNull()
    known, rare = with_idf(open_terms(rows.where(named), keys), idf, on, F.struct(*keys))
    common, rest = _raw_weights(known, keys), _raw_weights(rare, keys)
    rest = rest.select(*keys, F.col("raw").alias("rare"), F.col("squares").alias("rare_squares"))
    nothing = F.array().cast(common.schema["raw"].dataType)
    both = common.join(rest, keys, "full").select(
        *keys,
        F.concat(F.coalesce("raw", nothing), F.coalesce("rare", nothing)).alias("raw"),
        (F.coalesce("squares", F.lit(0.0)) + F.coalesce("rare_squares", F.lit(0.0))).alias("squares"),
    )
    # Rows without a key meet in no join by key.
    counts = idf.select(*on, F.col("df").alias("rows"))
    unnamed = split_join(open_terms(rows.where(~named), keys), values, on, spread_by=F.struct(*keys), counts=counts)
    return _scaled(both.unionByName(_raw_weights(unnamed, keys)), keys)


def with_idf(terms: DataFrame, idf: DataFrame, on: list[str], spread_by: Column) -> tuple[DataFrame, DataFrame]:
    """``terms`` with their idf, for a vocabulary beyond the broadcast limit: the common words, then the rare ones.

    As many of the most common words as fit are broadcast; most rows hold one of them and stay where
    they are. Only rows with rarer words are shuffled.
    """
    least = fitting_from(idf, [*on, "idf"], "df")
    common = F.broadcast(idf.where(F.col("df") >= least).select(*on, "idf"))
    rare = idf.where(F.col("df") < least)
    others = terms.join(common.select(*on), on, "left_anti")
    counts = rare.select(*on, F.col("df").alias("rows"))
    return terms.join(common, on), split_join(others, rare.select(*on, "idf"), on, spread_by=spread_by, counts=counts)


def _raw_weights(known: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, raw, squares)``: tf times idf of each term, and the sum of their squares."""
    raw = F.col("tf") * F.col("idf")
    return known.groupBy(*keys).agg(F.collect_list(F.struct(raw.alias("raw"), "term")).alias("raw"), F.sum(raw * raw).alias("squares"))


def _scaled(held: DataFrame, keys: list[str]) -> DataFrame:
    # The length is an aggregate, because an expression on the array would be evaluated for every element.
    length = F.sqrt("squares")
    scaled = F.transform("raw", lambda x: F.struct(rounded(x["raw"] / F.col("length")).alias("weight"), x["term"].alias("term")))
    return held.select(*keys, "raw", length.alias("length")).select(*keys, F.sort_array(scaled, asc=False).alias("weights"))


def tfidf_weights(terms: DataFrame, idf: DataFrame, key: str = "doc_id") -> DataFrame:
    """Tf times idf, scaled to unit length per text: ``(key, term, weight)``, from ``(key, term, tf)``."""
    rows = terms.groupBy(key).agg(F.collect_list(F.struct("term", "tf")).alias("terms"))
    return opened_weights(weighted_texts(rows, idf, [key]), [key])


def opened_weights(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, term, weight)`` of :func:`weighted_texts`."""
    return open_terms(weighted, keys, "weights").select(*keys, "term", "weight")


def heaviest(weighted: DataFrame, keys: list[str], k: int = 10) -> DataFrame:
    """The ``k`` heaviest terms of each text of :func:`weighted_texts`: ``(*keys, term, weight, place)``."""
    first = F.posexplode(F.slice("weights", 1, k)).alias("_place", "_w")
    return weighted.select(*keys, first).select(*keys, "_w.term", "_w.weight", (F.col("_place") + 1).alias("place"))


def top_keywords(weights: DataFrame, k: int = 10, key: str = "doc_id") -> DataFrame:
    """The ``k`` heaviest terms of each text of ``(key, term, weight)``, ties by term descending."""
    order = Window.partitionBy(key).orderBy(F.col("weight").desc(), F.col("term").desc())
    return weights.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def keyword_vectors(
    weighted: DataFrame,
    word_vectors: DataFrame,
    stopwords: DataFrame,
    dims: int,
    k: int = 10,
    keys: list[str] | None = None,
) -> DataFrame:
    """Mean vector of the ``k`` heaviest terms of each text of :func:`weighted_texts`, each counted once.

    ``(*keys, vec)``; words of one letter are left out, and so is a text that has no others.
    """
    keys = keys or ["doc_id"]
    first = F.filter(F.slice("weights", 1, k), lambda x: F.length(x["term"]) > 1)
    terms = F.transform(first, lambda x: F.struct(x["term"].alias("term"), F.lit(1).alias("tf")))
    rows = weighted.select(*keys, terms.alias("terms")).where(F.size("terms") > 0)
    return pool_terms(rows, word_vectors, stopwords, dims, keys)


def with_keywords(
    whole: DataFrame, keywords: DataFrame, keys: list[str], dims: int, keyword_weight: float
) -> DataFrame:
    """``keyword_weight`` times the keyword vector plus the text's own vector: ``(*keys, vec)``."""
    joined = whole.join(keywords.withColumnRenamed("vec", "keyword_vec"), keys, "left")
    return joined.select(*keys, scaled_sum(F.coalesce("keyword_vec", zeros(dims)), F.col("vec"), keyword_weight).alias("vec"))


def combined_vectors(
    texts: DataFrame,
    terms: DataFrame,
    idf: DataFrame,
    word_vectors: DataFrame,
    stopwords: DataFrame,
    dims: int,
    k: int = 10,
    keyword_weight: float = 5.0,
    key: str = "doc_id",
    text: str = "content",
) -> DataFrame:
    """Keyword and text vectors of ``texts``, whose ``terms(key, terms)`` are given: ``(key, vec)``."""
    keywords = keyword_vectors(weighted_texts(terms, idf, [key]), word_vectors, stopwords, dims, k, [key])
    whole = mean_pool(texts, word_vectors, stopwords, dims, key, text)
    return with_keywords(whole, keywords, [key], dims, keyword_weight)


def keyword_rerank(
    hits: DataFrame,
    docs: DataFrame,
    queries: DataFrame,
    idf: DataFrame,
    word_vectors: DataFrame,
    stopwords: DataFrame,
    dims: int,
    k: int = 20,
    keywords: int = 10,
    keyword_weight: float = 5.0,
    terms: DataFrame | None = None,
) -> DataFrame:
    """Rank candidates by the cosine of combined keyword and text vectors; keep the first ``k``.

    ``idf`` is a fitted model (:func:`fit_tfidf`, :func:`index_model`); ``terms(doc_id, terms)`` are the
    documents' terms if they are stored (:func:`forward_terms`). Only candidates are weighted.
    """
    hits = materialise(hits, "hits")
    idf = materialise(idf, "idf")
    ids = hits.select("doc_id").distinct()
    small = fits(hits.count())

    def of_hits(rows: DataFrame) -> DataFrame:
        return rows.join(broadcast_if(ids, small), "doc_id", "left_semi")

    wanted = of_hits(docs.select("doc_id", "content"))
    doc_terms = term_arrays(wanted) if terms is None else of_hits(terms)
    options = (idf, word_vectors, stopwords, dims, keywords, keyword_weight)
    doc_vectors = combined_vectors(wanted, doc_terms, *options)
    query_vectors = combined_vectors(queries, term_arrays(queries, "query_id", "query_text"), *options, "query_id", "query_text")
    return cosine_rerank(hits, doc_vectors, query_vectors, k)


def topic_models(
    docs: DataFrame, lexicon: DataFrame, stopwords: DataFrame, limit: int = 33
) -> DataFrame:
    """A tf-idf model for every topic, all in one table: ``(topic_id, term, df, idf)``.

    A topic's model is fitted on the noun phrases of the documents that are judged for it, the best
    grades first and at most ``limit``; documents without phrases count as texts.
    """
    annotation = F.col("annotation")
    judged = docs.select("doc_id", "content", topic_of(annotation).alias("topic_id"), grade_of(annotation).alias("grade"))
    best = Window.partitionBy("topic_id").orderBy(F.col("grade").desc(), "doc_id")
    fitted = judged.where("topic_id IS NOT NULL").withColumn("place", F.row_number().over(best)).where(F.col("place") <= limit)
    fitted = materialise(fitted.select("topic_id", "doc_id", "content"), "fit-corpora")
    pairs = noun_pairs(fitted, lexicon, "doc_id", standard_terms(F.col("content")))
    terms = phrase_terms(pairs, stopwords, "doc_id")
    texts = fitted.groupBy("topic_id").agg(F.count("*").alias("n_texts"))
    counted = terms.join(fitted.select("topic_id", "doc_id"), "doc_id").groupBy("topic_id", "term").agg(F.count("*").alias("df"))
    idf = F.log((F.col("n_texts") + 1) / (F.col("df") + 1)) + 1.0
    return counted.join(texts, "topic_id").select("topic_id", "term", "df", idf.alias("idf"))


def topic_rerank(
    hits: DataFrame,
    docs: DataFrame,
    queries: DataFrame,
    models: DataFrame,
    word_vectors: DataFrame,
    stopwords: DataFrame,
    dims: int,
    k: int = 20,
    keywords: int = 10,
    keyword_weight: float = 5.0,
    terms: DataFrame | None = None,
) -> DataFrame:
    """As :func:`keyword_rerank`, every query by the model of its topic (:func:`topic_models`).

    The candidates of all queries are weighted at once. A candidate of several topics has a vector for
    each of them; the vector of its text is made once. Without a model, or without terms that it knows,
    the text's vector stands alone.
    """
    hits = materialise(hits.select("query_id", "doc_id"), "hits")
    models = materialise(models, "topic-models")
    topics = queries.select("query_id", "topic_id")
    pairs = materialise(hits.join(topics, "query_id").select("topic_id", "doc_id").distinct(), "topic-candidates")
    small = fits(pairs.count())
    ids = pairs.select("doc_id").distinct()
    wanted = docs.select("doc_id", "content").join(broadcast_if(ids, small), "doc_id", "left_semi")
    doc_terms = term_arrays(wanted) if terms is None else terms
    by_topic = doc_terms.join(broadcast_if(pairs, small), "doc_id").select("topic_id", "doc_id", "terms")
    on = ["topic_id", "doc_id"]
    doc_words = keyword_vectors(weighted_texts(by_topic, models, on, ["topic_id"]), word_vectors, stopwords, dims, keywords, on)
    whole = pairs.join(mean_pool(wanted, word_vectors, stopwords, dims), "doc_id")
    doc_vectors = with_keywords(whole, doc_words, on, dims, keyword_weight)
    asked = term_arrays(queries, "query_id", "query_text").join(topics, "query_id")
    of_query = ["query_id", "topic_id"]
    query_words = keyword_vectors(weighted_texts(asked, models, of_query, ["topic_id"]), word_vectors, stopwords, dims, keywords, of_query)
    query_whole = mean_pool(queries, word_vectors, stopwords, dims, of_query, "query_text")
    query_vectors = with_keywords(query_whole, query_words, of_query, dims, keyword_weight)
    joined = hits.join(query_vectors.withColumnRenamed("vec", "query_vec"), "query_id").join(
        doc_vectors.withColumnRenamed("vec", "doc_vec"), on, "left"
    )
    similarity = rounded(cosine(F.col("query_vec"), F.col("doc_vec")))
    return ranked(joined.select("query_id", "doc_id", similarity.alias("score")), k)
