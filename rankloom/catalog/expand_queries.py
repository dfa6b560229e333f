"""Query expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.catalog import inputs as I
from rankloom.catalog.registry import query
from rankloom.catalog.views import cased, norm_terms, pooled, with_views
from rankloom.plans.scratch import materialise
from rankloom.operators import graph, phrases, pooling, search, senses
from rankloom.operators.expand_all import expand_queries
from rankloom.operators.senses import SenseStrategy

TOKENS = {
    "q_words": f"""
        SELECT query_id, query_text, CAST(unnest(generate_series(0, len(t) - 1)) AS INTEGER) AS pos, unnest(t) AS token
        FROM (SELECT query_id, query_text, {cased('query_text')} AS t FROM queries)""",
    "q_tokens": "SELECT query_id, pos, token FROM q_words WHERE token NOT IN (SELECT term FROM stopwords)",
    "candidates": """
        SELECT t.query_id, t.pos, t.token, s.sense_rank, s.sense_id
        FROM q_tokens t JOIN senses s ON s.term = lower(t.token)""",
    "sense_names": "SELECT sense_id, string_agg(replace(lemma, '_', ' '), ' ' ORDER BY lemma_no) AS names FROM lemmas GROUP BY sense_id",
    "sense_texts": """
        SELECT coalesce(n.sense_id, d.sense_id) AS sense_id, concat_ws(' ', n.names, d.definition) AS text
        FROM sense_names n FULL JOIN definitions d ON d.sense_id = n.sense_id""",
    "lesk_scored": f"""
        SELECT c.*, len(list_distinct(list_intersect({cased('q.query_text')},
                                                     string_split(coalesce(d.definition, ''), ' ')))) AS v
        FROM candidates c JOIN queries q ON q.query_id = c.query_id LEFT JOIN definitions d ON d.sense_id = c.sense_id""",
    "q_vec": "SELECT query_id, list(v ORDER BY dim) AS vec FROM query_pool GROUP BY query_id",
    "s_vec": "SELECT sense_id, list(v ORDER BY dim) AS vec FROM sense_pool GROUP BY sense_id",
    "vector_scored": """
        SELECT c.*, round(CASE WHEN s.vec IS NULL OR list_dot_product(q.vec, q.vec) = 0 OR list_dot_product(s.vec, s.vec) = 0
                               THEN -2.0 ELSE list_cosine_similarity(q.vec, s.vec) END, 6) AS v
        FROM candidates c JOIN q_vec q ON q.query_id = c.query_id LEFT JOIN s_vec s ON s.sense_id = c.sense_id""",
    "first_scored": "SELECT *, 0 AS v FROM candidates",
} | pooled("sense_pool", "sense_texts", "sense_id", "text")


def chosen(scored: str) -> dict[str, str]:
    """Views ``chosen``, ``chosen_lemmas`` and ``expanded`` for one strategy."""
    return TOKENS | {
        "chosen": f"""
            SELECT query_id, pos, token, sense_id FROM (
              SELECT *, row_number() OVER (PARTITION BY query_id, pos ORDER BY v DESC, sense_rank) AS r FROM {scored})
            WHERE r = 1""",
        "chosen_lemmas": """
            SELECT c.query_id, c.pos, c.token, c.sense_id, l.lemma_no, replace(l.lemma, '_', ' ') AS lemma
            FROM chosen c JOIN lemmas l ON l.sense_id = c.sense_id
            WHERE len(list_filter(string_split(replace(l.lemma, '_', ' '), ' '), lambda w: length(w) <= 2)) = 0""",
        "added": """
            SELECT query_id, string_agg(lemma, ' ' ORDER BY pos, lemma_no) AS words FROM chosen_lemmas GROUP BY query_id""",
        "expanded": """
            SELECT q.query_id, q.topic_id, q.query_type, concat(q.query_text, ' ', coalesce(a.words, '')) AS query_text
            FROM queries q LEFT JOIN added a ON a.query_id = q.query_id""",
    }


def sense_candidates(spark, d):
    tokens = senses.content_tokens(I.queries(spark, d), I.stopwords(spark, d))
    return senses.token_senses(tokens, I.senses(spark, d))


def expand(spark, d, strategy, queries=None):
    return senses.expand_senses(
        I.queries(spark, d) if queries is None else queries, I.senses(spark, d), I.lemmas(spark, d), I.definitions(spark, d),
        I.stopwords(spark, d), strategy,
        I.word_vectors(spark, d) if strategy is SenseStrategy.VECTOR else None, I.DIMS,
    )


@query("U2", with_views("SELECT query_id, pos, token FROM q_tokens", TOKENS))
def query_tokens_without_stopwords(spark, d):
    """Case-sensitive: a capitalised stop word stays."""
    return senses.content_tokens(I.queries(spark, d), I.stopwords(spark, d))


@query("J5", with_views("SELECT query_id, pos, token, sense_rank, sense_id FROM candidates", TOKENS))
def token_senses(spark, d):
    return sense_candidates(spark, d).select("query_id", "pos", "token", "sense_rank", "sense_id")


@query("W6 X4", with_views("SELECT query_id, pos, token, sense_id FROM chosen", chosen("first_scored")))
def first_senses(spark, d):
    return senses.first_senses(sense_candidates(spark, d))


@query("U5 W5 X4", with_views("SELECT query_id, pos, token, sense_id FROM chosen", chosen("lesk_scored")))
def lesk_senses(spark, d):
    return senses.lesk_senses(
        sense_candidates(spark, d), I.queries(spark, d), I.definitions(spark, d)
    )


@query("W5 F13 X4", with_views("SELECT query_id, pos, token, sense_id FROM chosen", chosen("vector_scored")))
def vector_senses(spark, d):
    words, stops = I.word_vectors(spark, d), I.stopwords(spark, d)
    texts = senses.sense_texts(I.lemmas(spark, d), I.definitions(spark, d))
    return senses.vector_senses(
        sense_candidates(spark, d),
        pooling.mean_pool(I.queries(spark, d), words, stops, I.DIMS, "query_id", "query_text"),
        materialise(pooling.mean_pool(texts, words, stops, I.DIMS, "sense_id", "text"), "sense-vectors"),
    )


@query("J6 P15 F18", with_views(
    "SELECT query_id, pos, token, sense_id, lemma_no, lemma FROM chosen_lemmas", chosen("first_scored")))
def sense_lemmas(spark, d):
    found = senses.sense_lemmas(senses.first_senses(sense_candidates(spark, d)), I.lemmas(spark, d))
    return found.select("query_id", "pos", "token", "sense_id", "lemma_no", "lemma")


@query("C7 C9 F19 X3", with_views("SELECT query_id, topic_id, query_type, query_text FROM expanded", chosen("first_scored")))
def expansion_by_first_sense(spark, d):
    return expand_queries(I.queries(spark, d), lambda asked: expand(spark, d, SenseStrategy.FIRST, asked))


@query("C7 F19", with_views("SELECT query_id, topic_id, query_type, query_text FROM expanded", chosen("lesk_scored")))
def expansion_by_definition(spark, d):
    return expand(spark, d, SenseStrategy.LESK)


@query("C7 F19", with_views("SELECT query_id, topic_id, query_type, query_text FROM expanded", chosen("vector_scored")))
def expansion_by_vector(spark, d):
    return expand(spark, d, SenseStrategy.VECTOR)


def expanded_search() -> dict[str, str]:
    from rankloom.catalog.views import search_views, tok

    return chosen("first_scored") | search_views("wide", tok("content"), tok("query_text"), queries="expanded")


@query("C1 C7 C9", with_views(
    "SELECT query_id, doc_id, score, rank FROM wide_hits WHERE rank <= 20", expanded_search()))
def search_with_expanded_queries(spark, d):
    """Expanded queries repeat words on purpose; each repetition counts."""
    expanded = expand(spark, d, SenseStrategy.FIRST)
    return search.bm25_search(I.content_index(spark, d), expanded, "content", 20)


GRAPH = {
    "g_words": f"""
        SELECT query_id, pos, first, second FROM (
          SELECT query_id, pos, token AS first, lead(token) OVER (PARTITION BY query_id ORDER BY pos) AS second
          FROM (SELECT query_id, CAST(unnest(generate_series(0, len(t) - 1)) AS INTEGER) AS pos, unnest(t) AS token
                FROM (SELECT query_id, {cased('query_text')} AS t FROM graph_queries)))""",
    "g_phrases": """
        SELECT w.query_id, w.pos, concat(w.first, ' ', w.second) AS phrase
        FROM g_words w JOIN graph_lexicon a ON a.term = w.first JOIN graph_lexicon b ON b.term = w.second
        WHERE a.tag IN ('ADJ', 'NOUN') AND b.tag = 'NOUN'
          AND w.first NOT IN ('relevant', 'document', 'documents') AND w.second NOT IN ('relevant', 'document', 'documents')""",
    "g_parts": """
        SELECT phrase, place, 0 AS part, label AS term FROM entities
        UNION ALL SELECT phrase, place, 1, description FROM entities""",
    "g_terms": """
        SELECT phrase, place, part, term FROM g_parts
        WHERE term IS NOT NULL AND term <> '' AND NOT regexp_matches(term, '^Q[0-9]+')""",
    "g_added": """
        SELECT p.query_id, string_agg(t.term, ' ' ORDER BY p.pos, t.place, t.part) AS words
        FROM g_phrases p JOIN g_terms t ON t.phrase = p.phrase GROUP BY p.query_id""",
}


def graph_phrases(spark, d):
    return graph.query_phrases(I.graph_queries(spark, d), I.graph_lexicon(spark, d))


def graph_entities(spark, d):
    return graph.phrase_entities(
        graph_phrases(spark, d), I.instance_of(spark, d), I.subclass_of(spark, d),
        I.graph_labels(spark, d),
    )


@query("P18 F20", with_views("SELECT query_id, pos, phrase FROM g_phrases", GRAPH))
def query_noun_phrases(spark, d):
    return graph_phrases(spark, d)


@query("J7", with_views("SELECT phrase, class FROM closure"))
def subclass_closure(spark, d):
    labels = I.graph_labels(spark, d)
    classes = I.kg_classes(spark, d).select("entity")
    roots = labels.join(classes, "entity").select(
        F.col("label").alias("phrase"), F.col("entity").alias("class")
    )
    return graph.subclasses(roots, I.subclass_of(spark, d))


@query("J7 J8 U4 T5 F20", with_views("SELECT phrase, place, entity, label, description FROM entities"))
def graph_entities_of_phrases(spark, d):
    """At most fifty entities per phrase, as the graph request asks for."""
    return graph_entities(spark, d)


@query("P16 P17", with_views("SELECT phrase, place, part, term FROM g_terms", GRAPH))
def graph_terms(spark, d):
    return graph.entity_terms(graph_entities(spark, d))


@query("C8 C9 F19 X3", with_views("""
    SELECT q.query_id, concat(q.query_text, ' ', coalesce(a.words, '')) AS query_text
    FROM graph_queries q LEFT JOIN g_added a ON a.query_id = q.query_id""", GRAPH))
def expansion_by_graph(spark, d):
    def expander(queries):
        return graph.expand_graph(
            queries, I.graph_lexicon(spark, d), I.instance_of(spark, d), I.subclass_of(spark, d),
            I.graph_labels(spark, d),
        )

    return expand_queries(I.graph_queries(spark, d), expander)
