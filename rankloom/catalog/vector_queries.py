"""Vectors, reranking and tf-idf."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from rankloom.catalog import inputs as I
from rankloom.catalog.registry import query
from rankloom.catalog.search_queries import METRICS_SQL, PAGE_VIEWS, UNION_VIEWS, content_hits, r6, united_hits
from rankloom.catalog.views import norm_terms, pooled, rank, tok, with_views
from rankloom.functions import vectors
from rankloom.functions.text import count_terms, normalized_terms, standard_terms
from rankloom.operators import evaluate, phrases, pooling, report, rerank, search, tfidf
from rankloom.plans.joins import fits, lookup_join
from rankloom.plans.scratch import materialise
from rankloom.sources.topics import query_or_topic_text


def by_dimension(df, key: str):
    """Vectors as rows, rounded: ``(key, dim, v)``, dimensions from 1."""
    exploded = df.select(key, F.posexplode("vec").alias("place", "x"))
    return exploded.select(key, (F.col("place") + 1).alias("dim"), r6("x", "v"))


PAIR_VIEWS = {
    "pairs": """
        SELECT q.query_id, h.doc_id, q.vec AS a, v.vec AS b
        FROM top20 h JOIN query_vectors q ON q.query_id = h.query_id JOIN doc_vectors v ON v.doc_id = h.doc_id""",
}


def vector_pairs(spark, d):
    """Query vector ``a`` and document vector ``b`` of each hit."""
    hits = materialise(content_hits(spark, d).select("query_id", "doc_id"), "hits")
    docs = rerank.of_candidates(I.doc_vectors(spark, d), hits, fits(hits.count()))
    return (
        hits.join(docs.withColumnRenamed("vec", "b"), "doc_id")
        .join(I.query_vectors(spark, d).withColumnRenamed("vec", "a"), "query_id")
        .select("query_id", "doc_id", "a", "b")
    )


@query("F12", with_views(
    "SELECT query_id, doc_id, round(list_dot_product(a, b), 6) + 0.0 AS dot FROM pairs", PAIR_VIEWS))
def dot_products(spark, d):
    dot = vectors.dot(F.col("a"), F.col("b"))
    return vector_pairs(spark, d).select("query_id", "doc_id", F.round(dot, 6).alias("dot"))


@query("F13", with_views(
    "SELECT query_id, doc_id, round(list_cosine_similarity(a, b), 6) + 0.0 AS cosine FROM pairs", PAIR_VIEWS))
def cosine_similarities(spark, d):
    cosine = vectors.cosine(F.col("a"), F.col("b"))
    return vector_pairs(spark, d).select("query_id", "doc_id", F.round(cosine, 6).alias("cosine"))


@query("F14", with_views("""
    SELECT query_id, doc_id, round(list_cosine_similarity(a, b) + 1.0, 6) AS second_score FROM pairs""", PAIR_VIEWS))
def shifted_cosines(spark, d):
    shifted = vectors.cosine_plus_one(F.col("a"), F.col("b"))
    return vector_pairs(spark, d).select(
        "query_id", "doc_id", F.round(shifted, 6).alias("second_score")
    )


@query("F15", with_views("""
    SELECT query_id, doc_id, CAST(u.dim AS INTEGER) AS dim, round(5 * a[u.dim] + b[u.dim], 6) + 0.0 AS v
    FROM pairs, (SELECT unnest(generate_series(1, 64)) AS dim) u""", PAIR_VIEWS))
def weighted_vector_sums(spark, d):
    summed = vectors.scaled_sum(F.col("a"), F.col("b"), 5.0)
    rows = vector_pairs(spark, d).select(
        "query_id", "doc_id", F.posexplode(summed).alias("place", "x")
    )
    return rows.select("query_id", "doc_id", (F.col("place") + 1).alias("dim"), r6("x", "v"))


@query("J4", with_views(f"""
    SELECT t.doc_id, t.term, t.tf, w.vec IS NOT NULL AS known, round(coalesce(w.vec[1], 0.0), 6) + 0.0 AS v1
    FROM (SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf
          FROM (SELECT doc_id, unnest({norm_terms('content')}) AS term FROM corpus) GROUP BY doc_id, term) t
    LEFT JOIN word_vectors w ON w.term = t.term"""))
def word_vector_lookup(spark, d):
    """Vector of every document word, the zero vector for unknown words."""
    tokens = normalized_terms(F.lit(""), F.col("content")).alias("tokens")
    counted = count_terms(I.corpus(spark, d).select("doc_id", tokens), ["doc_id"])
    found = lookup_join(
        counted, I.word_vectors(spark, d).select("term", "vec"), ["term"], "left"
    )
    vec = F.coalesce("vec", vectors.zeros(I.DIMS))
    return found.select(
        "doc_id", "term", "tf", F.col("vec").isNotNull().alias("known"), F.round(vec[0], 6).alias("v1")
    )


@query("A12 X1 F8", with_views("SELECT doc_id, dim, round(v, 6) + 0.0 AS v FROM doc_pool"))
def mean_pooled_documents(spark, d):
    pooled_docs = pooling.mean_pool(
        I.corpus(spark, d), I.word_vectors(spark, d), I.stopwords(spark, d), I.DIMS
    )
    return by_dimension(pooled_docs, "doc_id")


@query("A12", with_views("SELECT query_id, dim, round(v, 6) + 0.0 AS v FROM query_pool"))
def mean_pooled_queries(spark, d):
    pooled_queries = pooling.mean_pool(
        I.queries(spark, d), I.word_vectors(spark, d), I.stopwords(spark, d), I.DIMS,
        "query_id", "query_text",
    )
    return by_dimension(pooled_queries, "query_id")


def letter_model():
    """A stand-in for a user's model: length, and the counts of three letters."""

    def predict(texts: np.ndarray) -> np.ndarray:
        rows = [[len(t), t.count("a"), t.count("e"), t.count("n")] for t in texts.ravel()]
        return np.array(rows, dtype="float64")

    return predict


@query("X1 T6", with_views("""
    SELECT doc_id, chunk_no, CAST(length(chunk) AS DOUBLE) AS n,
           CAST(length(chunk) - length(replace(chunk, 'a', '')) AS DOUBLE) AS a,
           CAST(length(chunk) - length(replace(chunk, 'e', '')) AS DOUBLE) AS e,
           CAST(length(chunk) - length(replace(chunk, 'n', '')) AS DOUBLE) AS letter_n FROM chunks"""))
def batch_encoded_chunks(spark, d):
    """Chunks encoded in batches of 256 by a user's model."""
    encoded = pooling.encode(I.chunks(spark, d), letter_model, "chunk", 256)
    vec = F.col("vec")
    return encoded.select(
        "doc_id", "chunk_no", vec[0].alias("n"), vec[1].alias("a"), vec[2].alias("e"),
        vec[3].alias("letter_n"),
    )


CHUNK_VIEWS = {
    "best_chunks": """
        SELECT h.query_id, h.doc_id, round(max(list_dot_product(q.vec, c.vec)), 6) AS best
        FROM {hits} h JOIN query_vectors q ON q.query_id = h.query_id JOIN chunk_vectors c ON c.doc_id = h.doc_id
        GROUP BY h.query_id, h.doc_id""",
}


def chunk_views(hits: str) -> dict[str, str]:
    return {"best_chunks": CHUNK_VIEWS["best_chunks"].format(hits=hits)}


@query("A13", with_views("SELECT query_id, doc_id, best AS score FROM best_chunks", chunk_views("top20")))
def best_chunk_dot(spark, d):
    hits = materialise(content_hits(spark, d).select("query_id", "doc_id"), "hits")
    pairs = hits.join(I.chunk_vectors(spark, d).withColumnRenamed("vec", "b"), "doc_id").join(
        I.query_vectors(spark, d).withColumnRenamed("vec", "a"), "query_id"
    )
    best = pooling.max_pool(pairs, vectors.dot(F.col("a"), F.col("b")))
    return best.select("query_id", "doc_id", r6("best", "score"))


@query("C5 T1 U1 A13 W1", with_views(
    f"SELECT query_id, doc_id, best AS score, {rank('best')} AS rank FROM best_chunks",
    UNION_VIEWS | chunk_views("united")))
def chunk_rerank(spark, d):
    """Content and title hits ranked by their best chunk."""
    return rerank.chunk_rerank(
        united_hits(spark, d), I.chunk_vectors(spark, d), I.query_vectors(spark, d)
    )


RESCORE_VIEWS = {
    "rescored": """
        SELECT p.query_id, p.doc_id,
               round({qw} * h.score + {rw} * coalesce(list_cosine_similarity(p.a, p.b) + 1.0, 0.0), 6) AS score
        FROM pairs p JOIN top20 h ON h.query_id = p.query_id AND h.doc_id = p.doc_id""",
}


def rescore_views(qw: float, rw: float) -> dict[str, str]:
    return PAIR_VIEWS | {"rescored": RESCORE_VIEWS["rescored"].format(qw=qw, rw=rw)}


@query("C2 W2 F14", with_views(
    f"SELECT query_id, doc_id, score, {rank('score')} AS rank FROM rescored", rescore_views(0, 1)))
def cosine_rescore(spark, d):
    return rerank.rescore(
        content_hits(spark, d), I.doc_vectors(spark, d), I.query_vectors(spark, d), window=20
    )


@query("W2", with_views("""
    SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id
        ORDER BY block, score DESC, CAST(doc_id AS VARCHAR) DESC) AS INTEGER) AS rank
    FROM (SELECT h.query_id, h.doc_id, CASE WHEN h.rank <= 10 THEN r.score ELSE h.score END AS score,
                 CASE WHEN h.rank <= 10 THEN 0 ELSE h.rank END AS block
          FROM top20 h JOIN rescored r ON r.query_id = h.query_id AND r.doc_id = h.doc_id)""",
    rescore_views(0.3, 2)))
def windowed_rescore(spark, d):
    """Only the first ten of twenty hits are rescored, with both scores weighed."""
    return rerank.rescore(
        content_hits(spark, d), I.doc_vectors(spark, d), I.query_vectors(spark, d), 10, 0.3, 2.0
    )


@query("A14", with_views("SELECT term, df, round(idf, 6) AS idf FROM idf"))
def tfidf_model(spark, d):
    docs = I.corpus(spark, d)
    return tfidf.fit_tfidf(tfidf.term_rows(docs), docs).select("term", "df", r6("idf"))


WEIGHT_VIEWS = {
    "weights": """
        SELECT doc_id, term, round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)), 6) AS weight
        FROM doc_terms JOIN idf USING (term)""",
    "keywords": """
        SELECT doc_id, term, weight, place FROM (
          SELECT doc_id, term, weight,
                 CAST(row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term DESC) AS INTEGER) AS place
          FROM weights) WHERE place <= 10""",
}


def document_weights(spark, d):
    """Weights of the stored terms, by the stored document frequencies."""
    stored = I.content_index(spark, d)
    return tfidf.weighted_texts(tfidf.forward_terms(stored), tfidf.index_model(stored), ["doc_id"])


@query("A15", with_views("SELECT doc_id, term, weight FROM weights", WEIGHT_VIEWS))
def tfidf_weights(spark, d):
    return tfidf.opened_weights(document_weights(spark, d), ["doc_id"])


@query("T3", with_views("SELECT doc_id, term, weight, place FROM keywords", WEIGHT_VIEWS))
def top_keywords(spark, d):
    return tfidf.heaviest(document_weights(spark, d), ["doc_id"], 10)


KEYWORD_POOL = {
    "kw_valid": """
        SELECT doc_id, term FROM keywords WHERE length(term) > 1 AND term NOT IN (SELECT term FROM stopwords)""",
    "kw_n": "SELECT doc_id, count(*) AS n FROM kw_valid GROUP BY doc_id",
    "kw_sum": """
        SELECT k.doc_id, u.dim, sum(w.vec[u.dim]) AS v FROM kw_valid k JOIN word_vectors w ON w.term = k.term,
               (SELECT unnest(generate_series(1, 64)) AS dim) u GROUP BY k.doc_id, u.dim""",
    "kw_docs": "SELECT DISTINCT doc_id FROM keywords WHERE length(term) > 1",
}


@query("F22", with_views("""
    SELECT d.doc_id, CAST(u.dim AS INTEGER) AS dim, round(coalesce(s.v / n.n, 0.0), 6) + 0.0 AS v
    FROM kw_docs d CROSS JOIN (SELECT unnest(generate_series(1, 64)) AS dim) u
    LEFT JOIN kw_n n ON n.doc_id = d.doc_id LEFT JOIN kw_sum s ON s.doc_id = d.doc_id AND s.dim = u.dim""",
    WEIGHT_VIEWS | KEYWORD_POOL))
def keyword_vectors(spark, d):
    built = tfidf.keyword_vectors(
        document_weights(spark, d), I.word_vectors(spark, d), I.stopwords(spark, d), I.DIMS
    )
    return by_dimension(built, "doc_id")


def combined_views(name: str, source: str, key: str, text: str) -> dict[str, str]:
    """Keyword vector times five plus mean vector: ``<name>(key, vec)``."""
    return {
        f"{name}_w": f"""
            SELECT {key}, term, round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY {key})), 6) AS weight
            FROM (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest({tok(text)}) AS term FROM {source})
                  GROUP BY {key}, term) JOIN idf USING (term)""",
        f"{name}_k": f"""
            SELECT {key}, term FROM (
              SELECT {key}, term, row_number() OVER (PARTITION BY {key} ORDER BY weight DESC, term DESC) AS place
              FROM {name}_w) WHERE place <= 10 AND length(term) > 1 AND term NOT IN (SELECT term FROM stopwords)""",
        f"{name}_kn": f"SELECT {key}, count(*) AS n FROM {name}_k GROUP BY {key}",
        f"{name}_ks": f"""
            SELECT k.{key}, u.dim, sum(w.vec[u.dim]) AS v FROM {name}_k k JOIN word_vectors w ON w.term = k.term,
                   (SELECT unnest(generate_series(1, 64)) AS dim) u GROUP BY k.{key}, u.dim""",
        name: f"""
            SELECT p.{key}, list(5 * coalesce(s.v / n.n, 0.0) + p.v ORDER BY p.dim) AS vec
            FROM {name}_p p LEFT JOIN {name}_kn n ON n.{key} = p.{key}
            LEFT JOIN {name}_ks s ON s.{key} = p.{key} AND s.dim = p.dim GROUP BY p.{key}""",
    } | pooled(f"{name}_p", source, key, text)


KEYWORD_RERANK = (
    {
        "top150": "SELECT query_id, doc_id FROM content_hits WHERE rank <= 150",
        "wanted": "SELECT doc_id, content FROM corpus WHERE doc_id IN (SELECT doc_id FROM top150)",
        "similar_docs": """
            SELECT h.query_id, h.doc_id, round(CASE WHEN list_dot_product(q.vec, q.vec) = 0 OR list_dot_product(c.vec, c.vec) = 0
                THEN NULL ELSE list_cosine_similarity(q.vec, c.vec) END, 6) AS score
            FROM top150 h JOIN q_comb q ON q.query_id = h.query_id JOIN d_comb c ON c.doc_id = h.doc_id""",
    }
    | combined_views("d_comb", "wanted", "doc_id", "content")
    | combined_views("q_comb", "queries", "query_id", "query_text")
)


@query("C4 T2", with_views(
    f"SELECT query_id, doc_id, score, rank FROM (SELECT *, {rank('score')} AS rank FROM similar_docs) WHERE rank <= 20",
    KEYWORD_RERANK))
def keyword_rerank(spark, d):
    """150 candidates reranked by keyword vectors, twenty kept; the model is fitted on the corpus."""
    stored = I.content_index(spark, d)
    return tfidf.keyword_rerank(
        content_hits(spark, d, 150), stored.documents, I.queries(spark, d), tfidf.index_model(stored),
        I.word_vectors(spark, d), I.stopwords(spark, d), I.DIMS, k=20, terms=tfidf.forward_terms(stored),
    )


PHRASE_SQL = """
    SELECT doc_id, pos, first, second FROM (
      SELECT doc_id, pos, term AS first, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS second
      FROM (SELECT doc_id, CAST(unnest(generate_series(0, len(t) - 1)) AS INTEGER) AS pos, unnest(t) AS term
            FROM (SELECT doc_id, {tokens} AS t FROM corpus))) p
    JOIN lexicon a ON a.term = p.first JOIN lexicon b ON b.term = p.second
    WHERE a.tag IN ('ADJ', 'NOUN') AND b.tag = 'NOUN'
      AND first NOT IN ('relevant', 'document', 'documents') AND second NOT IN ('relevant', 'document', 'documents')"""
PHRASE_VIEWS = {"phrases": PHRASE_SQL.format(tokens=tok("content"))}


def document_pairs(spark, d):
    tokens = standard_terms(F.col("content"))
    return phrases.noun_pairs(I.corpus(spark, d), I.lexicon(spark, d), "doc_id", tokens)


@query("P18 W4 U3", with_views("SELECT doc_id, pos, first, second FROM phrases", PHRASE_VIEWS))
def noun_pairs(spark, d):
    return document_pairs(spark, d)


@query("W4", with_views(f"""
    SELECT query_id, pos, first, second FROM (
      SELECT query_id, pos, term AS first, lead(term) OVER (PARTITION BY query_id ORDER BY pos) AS second
      FROM (SELECT query_id, CAST(unnest(generate_series(0, len(t) - 1)) AS INTEGER) AS pos, unnest(t) AS term
            FROM (SELECT query_id, {tok('query_text')} AS t FROM queries))) WHERE second IS NOT NULL"""))
def adjacent_words(spark, d):
    tokens = standard_terms(F.col("query_text"))
    return phrases.adjacent_pairs(I.queries(spark, d), "query_id", tokens)


@query("C13 P14", with_views("""
    SELECT term, count(*) AS df, round(ln((1.0 + (SELECT count(*) FROM corpus)) / (1.0 + count(*))) + 1.0, 6) AS idf
    FROM (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, first AS term FROM phrases
                                             UNION ALL SELECT doc_id, second FROM phrases)
          WHERE regexp_full_match(term, '\\p{L}+') AND term NOT IN (SELECT term FROM stopwords)) GROUP BY term""",
    PHRASE_VIEWS))
def noun_phrase_model(spark, d):
    """A tf-idf model fitted on the noun phrases alone."""
    words = phrases.phrase_terms(document_pairs(spark, d), I.stopwords(spark, d), "doc_id")
    return tfidf.fit_tfidf(words, I.corpus(spark, d)).select("term", "df", r6("idf"))


TOPIC_MODELS = PHRASE_VIEWS | {
    "fit_docs": """
        SELECT topic_id, doc_id FROM (
          SELECT topic_id, doc_id, row_number() OVER (PARTITION BY topic_id ORDER BY grade DESC, doc_id) AS place FROM annotated)
        WHERE place <= 33""",
    "topic_idf": """
        SELECT f.topic_id, t.term, count(*) AS df, ln((1.0 + any_value(n.n)) / (1.0 + count(*))) + 1.0 AS idf
        FROM (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, first AS term FROM phrases
                                                 UNION ALL SELECT doc_id, second FROM phrases)
              WHERE regexp_full_match(term, '\\p{L}+') AND term NOT IN (SELECT term FROM stopwords)) t
        JOIN fit_docs f ON f.doc_id = t.doc_id
        JOIN (SELECT topic_id, count(*) AS n FROM fit_docs GROUP BY topic_id) n ON n.topic_id = f.topic_id
        GROUP BY f.topic_id, t.term""",
}


@query("C4 P20 C13 A14", with_views("SELECT topic_id, term, df, round(idf, 6) AS idf FROM topic_idf", TOPIC_MODELS))
def topic_tfidf_models(spark, d):
    """The tf-idf models of all topics, each fitted on the noun phrases of its judged documents."""
    models = tfidf.topic_models(I.content_index(spark, d).documents, I.lexicon(spark, d), I.stopwords(spark, d))
    return models.select("topic_id", "term", "df", r6("idf"))


def topic_combined(name: str, keys: str, terms: str, whole: str, key: str) -> dict[str, str]:
    """Keyword vector by the topic's model times five plus mean vector: ``<name>(keys, vec)``."""
    both = keys.split(", ")
    same = " AND ".join(f"b.{k} = a.{k}" for k in both)
    own = ", ".join(f"a.{k}" for k in both)
    return {
        f"{name}_w": f"""
            SELECT {own}, a.term, round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY {own})), 6) AS weight
            FROM ({terms}) a JOIN topic_idf b ON b.topic_id = a.topic_id AND b.term = a.term""",
        f"{name}_k": f"""
            SELECT {keys}, term FROM (
              SELECT {keys}, term, row_number() OVER (PARTITION BY {keys} ORDER BY weight DESC, term DESC) AS place FROM {name}_w)
            WHERE place <= 10 AND length(term) > 1 AND term NOT IN (SELECT term FROM stopwords)""",
        f"{name}_kn": f"SELECT {keys}, count(*) AS n FROM {name}_k GROUP BY {keys}",
        f"{name}_ks": f"""
            SELECT {own}, u.dim, sum(w.vec[u.dim]) AS v FROM {name}_k a JOIN word_vectors w ON w.term = a.term,
                   (SELECT unnest(generate_series(1, 64)) AS dim) u GROUP BY {own}, u.dim""",
        name: f"""
            SELECT {own}, list(5 * coalesce(s.v / n.n, 0.0) + p.v ORDER BY p.dim) AS vec
            FROM (SELECT DISTINCT {keys} FROM topic_hits) a JOIN {whole} p ON p.{key} = a.{key}
            LEFT JOIN {name}_kn n ON {same.replace('b.', 'n.')} LEFT JOIN {name}_ks s ON {same.replace('b.', 's.')} AND s.dim = p.dim
            GROUP BY {own}""",
    }


TOPIC_CHAIN = (
    TOPIC_MODELS
    | {
        "topic_hits": """
            SELECT h.query_id, q.topic_id, h.doc_id FROM content_hits h JOIN queries q ON q.query_id = h.query_id WHERE h.rank <= 150""",
        "topic_scores": """
            SELECT h.query_id, h.topic_id, h.doc_id,
                   round(CASE WHEN list_dot_product(q.vec, q.vec) = 0 OR list_dot_product(c.vec, c.vec) = 0
                         THEN NULL ELSE list_cosine_similarity(q.vec, c.vec) END, 6) AS score
            FROM topic_hits h JOIN tq_comb q ON q.query_id = h.query_id JOIN td_comb c ON c.doc_id = h.doc_id AND c.topic_id = h.topic_id""",
    }
    | topic_combined(
        "td_comb", "topic_id, doc_id",
        "SELECT h.topic_id, t.doc_id, t.term, t.tf FROM (SELECT DISTINCT topic_id, doc_id FROM topic_hits) h JOIN doc_terms t ON t.doc_id = h.doc_id",
        "doc_pool", "doc_id")
    | topic_combined(
        "tq_comb", "topic_id, query_id",
        "SELECT q.topic_id, t.query_id, t.term, t.tf FROM query_terms_tf t JOIN queries q ON q.query_id = t.query_id",
        "query_pool", "query_id")
)


@query("C4 P20 C13 T2 T3 F22 W1 J2", with_views(f"""
    SELECT r.query_id, r.doc_id, r.score, r.rank, coalesce(a.grade, 0) AS grade
    FROM (SELECT *, {rank('score')} AS rank FROM topic_scores) r
    LEFT JOIN annotated a ON a.doc_id = r.doc_id AND a.topic_id = r.topic_id WHERE r.rank <= 20""", TOPIC_CHAIN))
def topic_keyword_rerank(spark, d):
    """150 candidates reranked by the keywords of their topic's model, twenty kept and graded."""
    stored, queries = I.content_index(spark, d), I.queries(spark, d)
    words, stops = I.word_vectors(spark, d), I.stopwords(spark, d)
    models = tfidf.topic_models(stored.documents, I.lexicon(spark, d), stops)
    ranked = tfidf.topic_rerank(
        content_hits(spark, d, 150), stored.documents, queries, models, words, stops, I.DIMS, terms=tfidf.forward_terms(stored)
    )
    return evaluate.judge(ranked, queries, stored.documents)


GRID_VIEWS = {
    "bm_run": "SELECT 'bm_25' AS approach, query_id, doc_id, rank FROM top20",
    "custom_run": "SELECT 'custom' AS approach, query_id, doc_id, rank FROM custom_hits WHERE rank <= 20",
    "bert_scores": """
        SELECT h.query_id, h.doc_id, round(coalesce(list_cosine_similarity(q.vec, v.vec) + 1.0, 0.0), 6) AS score
        FROM top20 h JOIN query_vectors q ON q.query_id = h.query_id JOIN doc_vectors v ON v.doc_id = h.doc_id""",
    "bert_run": f"SELECT 'bert' AS approach, query_id, doc_id, {rank('score')} AS rank FROM bert_scores",
    "fast_q": "SELECT query_id, list(v ORDER BY dim) AS vec FROM query_pool GROUP BY query_id",
    "fast_d": "SELECT doc_id, list(v ORDER BY dim) AS vec FROM doc_pool GROUP BY doc_id",
    "fast_scores": """
        SELECT h.query_id, h.doc_id, round(CASE WHEN list_dot_product(q.vec, q.vec) = 0 OR list_dot_product(v.vec, v.vec) = 0
            THEN 0.0 ELSE list_cosine_similarity(q.vec, v.vec) + 1.0 END, 6) AS score
        FROM top20 h JOIN fast_q q ON q.query_id = h.query_id JOIN fast_d v ON v.doc_id = h.doc_id""",
    "fast_run": f"SELECT 'fast' AS approach, query_id, doc_id, {rank('score')} AS rank FROM fast_scores",
    "runs": """
        SELECT * FROM bm_run UNION ALL SELECT * FROM custom_run
        UNION ALL SELECT * FROM bert_run UNION ALL SELECT * FROM fast_run""",
    "graded_runs": """
        SELECT r.approach, r.query_id, r.rank, coalesce(a.grade, 0) AS grade
        FROM runs r JOIN queries q ON q.query_id = r.query_id
        LEFT JOIN annotated a ON a.doc_id = r.doc_id AND a.topic_id = q.topic_id""",
    "run_metrics": """
        SELECT approach, query_id, sum(CASE WHEN grade > 0 THEN 1 ELSE 0 END) / 20.0 AS prec,
               CASE WHEN sum(rel) = 0 THEN 0.0 ELSE sum(CASE WHEN rel = 1 THEN found / rank ELSE 0.0 END) / sum(rel) END AS ap,
               CASE WHEN sum(grade) = 0 THEN 0.0
                    ELSE sum(grade / log2(rank + 1.0)) / sum(grade / log2(ideal + 1.0)) END AS ndcg
        FROM (SELECT *, CASE WHEN grade > 0 THEN 1 ELSE 0 END AS rel,
                     CAST(sum(CASE WHEN grade > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY approach, query_id ORDER BY rank) AS DOUBLE) AS found,
                     row_number() OVER (PARTITION BY approach, query_id ORDER BY grade DESC, rank) AS ideal
              FROM graded_runs) GROUP BY approach, query_id""",
    "grid": """
        SELECT q.topic_id, q.query_type, a.approach, coalesce(m.prec, 0.0) AS prec, coalesce(m.ap, 0.0) AS ap,
               coalesce(m.ndcg, 0.0) AS ndcg
        FROM queries q CROSS JOIN (SELECT unnest(['bm_25', 'custom', 'bert', 'fast']) AS approach) a
        LEFT JOIN run_metrics m ON m.approach = a.approach AND m.query_id = q.query_id""",
}


def grid_scores(spark, d):
    stored, queries = I.content_index(spark, d, "content", "custom_content"), I.queries(spark, d)
    docs, words, stops = stored.documents, I.word_vectors(spark, d), I.stopwords(spark, d)
    found = search.shared_search(stored, {"bm_25": (queries, "content"), "custom": (queries, "custom_content")})
    plain = found["bm_25"]
    approaches = {
        **found,
        "bert": rerank.rescore(plain, I.doc_vectors(spark, d), I.query_vectors(spark, d), 20),
        "fast": rerank.rescore(
            plain,
            # Only documents that were hit are pooled.
            pooling.mean_pool(
                rerank.of_candidates(docs, plain, fits(plain.count())), words, stops, I.DIMS
            ).withColumnRenamed("vec", "ft_vector"),
            pooling.mean_pool(
                queries, words, stops, I.DIMS, "query_id", "query_text"
            ).withColumnRenamed("vec", "ft_vector"),
            20,
            column="ft_vector",
        ),
    }
    return evaluate.score_grid(approaches, queries, docs, 20)


@query("C10 J9 X5", with_views("""
    SELECT topic_id, query_type, approach, round(CAST(prec AS DOUBLE), 6) AS prec, round(ap, 6) AS ap,
           round(ndcg, 6) AS ndcg FROM grid""", GRID_VIEWS))
def evaluation_grid(spark, d):
    return grid_scores(spark, d).select(
        "topic_id", "query_type", "approach", r6("prec"), r6("ap"), r6("ndcg")
    )


@query("A8 C10", with_views("""
    SELECT approach, query_type, round(sum(ndcg) / (SELECT count(*) FROM topics), 6) AS mean_ndcg
    FROM grid GROUP BY approach, query_type""", GRID_VIEWS))
def evaluation_report(spark, d):
    return evaluate.grid_report(grid_scores(spark, d)).select(
        "approach", "query_type", r6("mean_ndcg")
    )


@query("C6 P6 T1 A13 J10 P7 W3", with_views(f"""
    SELECT query_id, doc_id, score, rank, title, snippet, grade FROM (
      SELECT b.query_id, b.doc_id, b.best AS score, {rank('b.best').replace('query_id', 'b.query_id').replace('(doc_id', '(b.doc_id')} AS rank,
             p.title, p.snippet, p.grade
      FROM best_chunks b JOIN page_hits p ON p.query_id = b.query_id AND p.doc_id = b.doc_id) WHERE rank <= 8""",
    PAGE_VIEWS | chunk_views("page_hits")))
def result_page(spark, d):
    """First page of sixteen hits ranked by their best chunk; empty requests use the topic's text."""
    requests = I.queries(spark, d).withColumn("query_text", F.lit(""))
    queries = query_or_topic_text(requests, I.topics(spark, d))
    hits = search.bm25_search(I.content_index(spark, d), queries, "content", 16)
    ranked = rerank.chunk_rerank(hits, I.chunk_vectors(spark, d), I.query_vectors(spark, d))
    return report.enriched_hits(report.page(ranked, 0), queries, I.content_index(spark, d).documents, 8)


PAGE_SCORE_VIEWS = {
    "page_results": """
        SELECT query_id, doc_id, rank FROM content_hits WHERE rank <= 16 AND NOT starts_with(query_id, '7-')
        UNION ALL SELECT query_id, doc_id, rank FROM title_hits WHERE rank <= 16 AND starts_with(query_id, '7-')""",
    "page_judged": """
        SELECT r.query_id, r.rank, coalesce(a.grade, 0) AS grade
        FROM page_results r JOIN queries q ON q.query_id = r.query_id
        LEFT JOIN annotated a ON a.doc_id = r.doc_id AND a.topic_id = q.topic_id""",
    "page_metrics": METRICS_SQL.format(judged="page_judged").replace("<= 20", "<= 8").replace("20.0", "8.0"),
}


@query("C6 A6 A7 A19 W3 P9", with_views("""
    SELECT q.query_id, CAST(coalesce(m.n_hits, 0) AS BIGINT) AS n_hits, CAST(coalesce(m.n_hits, 0) // 8 AS BIGINT) AS max_pages,
           round(CAST(coalesce(m.prec, 0) AS DOUBLE), 6) AS prec, round(coalesce(m.ap, 0), 6) AS ap,
           round(CASE WHEN coalesce(m.best, 0) = 0 THEN 0.0 ELSE m.dcg / m.best END, 6) AS ndcg,
           round(CASE WHEN coalesce(m.best_page, 0) = 0 THEN 0.0 ELSE CAST(m.page AS DOUBLE) / CAST(m.best_page AS DOUBLE) END, 6)
               AS first_page_ratio
    FROM queries q LEFT JOIN page_metrics m ON m.query_id = q.query_id""", PAGE_SCORE_VIEWS))
def result_page_scores(spark, d):
    """What stands beside the hits of a page: metrics, number of hits and last page; the field goes by topic."""
    queries, both = report.search_fields(I.queries(spark, d), ["7"], special="title"), ["content", "title"]
    stored = I.content_index(spark, d, *both)
    hits = materialise(search.bm25_search(stored, queries, both, 16), "hits")
    scores = evaluate.score(evaluate.judge(hits, queries, stored.documents), queries, k=8)
    counts = report.result_counts(hits).select("query_id", "max_pages")
    return scores.join(counts, "query_id", "left").select(
        "query_id", "n_hits", F.coalesce("max_pages", F.lit(0)).cast("long").alias("max_pages"),
        r6("prec"), r6("ap"), r6("ndcg"), r6("first_page_ratio"),
    )


@query("C6 P6 P7 P9 J10 T1 A6 A7 A19 W3", with_views("""
    SELECT r.query_id, r.doc_id, r.score, r.rank, CAST((r.rank - 1) // 8 AS BIGINT) AS page, c.title, substring(c.content, 1, 150) AS snippet,
           coalesce(a.grade, 0) AS grade, m.n_hits, m.n_hits // 8 AS max_pages, round(CAST(m.prec AS DOUBLE), 6) AS prec, round(m.ap, 6) AS ap,
           round(CASE WHEN m.best = 0 THEN 0.0 ELSE m.dcg / m.best END, 6) AS ndcg,
           round(CASE WHEN m.best_page = 0 THEN 0.0 ELSE CAST(m.page AS DOUBLE) / CAST(m.best_page AS DOUBLE) END, 6) AS first_page_ratio
    FROM routed r JOIN queries q ON q.query_id = r.query_id JOIN corpus c ON c.doc_id = r.doc_id JOIN page_metrics m ON m.query_id = r.query_id
    LEFT JOIN annotated a ON a.doc_id = r.doc_id AND a.topic_id = q.topic_id""", PAGE_SCORE_VIEWS | {"routed": """
        SELECT query_id, doc_id, score, rank FROM content_hits WHERE rank <= 16 AND NOT starts_with(query_id, '7-')
        UNION ALL SELECT query_id, doc_id, score, rank FROM title_hits WHERE rank <= 16 AND starts_with(query_id, '7-')"""}))
def routed_result_page(spark, d):
    """Hits, each topic's from its field, with title, snippet, grade, page number, metrics and last page."""
    queries, both = report.search_fields(I.queries(spark, d), ["7"], special="title"), ["content", "title"]
    stored = I.content_index(spark, d, *both)
    page = report.result_page(search.bm25_search(stored, queries, both, 16), queries, stored.documents)
    return page.select(
        "query_id", "doc_id", "score", "rank", "page", "title", "snippet", "grade", "n_hits", "max_pages",
        r6("prec"), r6("ap"), r6("ndcg"), r6("first_page_ratio"),
    )
