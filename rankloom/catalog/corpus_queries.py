"""Corpus preparation, summaries, files."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.catalog import inputs as I
from rankloom.catalog.expand_queries import chosen, expand
from rankloom.catalog.registry import query
from rankloom.catalog.search_queries import METRIC_VIEWS, all_metrics, r6
from rankloom.catalog.views import tok, with_views
from rankloom.operators import prepare, summarize, tfidf
from rankloom.operators.senses import SenseStrategy
from rankloom.plans.scratch import fresh_path, materialise
from rankloom.sources import corpus, reports, topics, triples, word_vectors

SUMMARY_VIEWS = {
    "c_sentences": """
        SELECT doc_id, chunk_no, CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS sentence_no, unnest(parts) AS s
        FROM (SELECT doc_id, chunk_no, string_split(chunk, '.') AS parts FROM chunks)""",
    "c_terms": f"SELECT doc_id, chunk_no, sentence_no, unnest({tok('s')}) AS term FROM c_sentences",
    # A chunk border may cut a word in two. Such a half has no document frequency and no weight,
    # but it counts in the sentence's length.
    "c_weights": """
        SELECT t.doc_id, t.chunk_no, t.sentence_no, round(sum(i.idf) / any_value(n.n), 6) AS weight
        FROM c_terms t JOIN idf i ON i.term = t.term
        JOIN (SELECT doc_id, chunk_no, sentence_no, count(*) AS n FROM c_terms GROUP BY ALL) n
          ON n.doc_id = t.doc_id AND n.chunk_no = t.chunk_no AND n.sentence_no = t.sentence_no
        GROUP BY t.doc_id, t.chunk_no, t.sentence_no""",
    "c_best": """
        SELECT doc_id, chunk_no, sentence_no FROM (
          SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_no ORDER BY weight DESC, sentence_no) AS r FROM c_weights)
        WHERE r = 1""",
    "c_summaries": """
        SELECT c.doc_id, c.chunk_no,
               coalesce(regexp_replace(string_split(c.chunk, '.')[b.sentence_no + 1], '^\\s+|\\s+$', '', 'g'), '') AS summary
        FROM chunks c LEFT JOIN c_best b ON b.doc_id = c.doc_id AND b.chunk_no = c.chunk_no""",
    "summaries": "SELECT doc_id, string_agg(summary, ' ' ORDER BY chunk_no) AS summary FROM c_summaries GROUP BY doc_id",
}


def corpus_idf(spark, d):
    return tfidf.index_model(I.content_index(spark, d))


@query("C3 F11 A15", with_views("SELECT doc_id, chunk_no, sentence_no, weight FROM c_weights", SUMMARY_VIEWS))
def sentence_weights(spark, d):
    return summarize.sentence_weights(I.chunks(spark, d), corpus_idf(spark, d))


@query("C3 X2", with_views("SELECT doc_id, chunk_no, summary FROM c_summaries", SUMMARY_VIEWS))
def chunk_summaries(spark, d):
    return summarize.extract_summaries(I.chunks(spark, d), corpus_idf(spark, d))


@query("C3 A17 F9", with_views("SELECT doc_id, summary FROM summaries", SUMMARY_VIEWS))
def document_summaries(spark, d):
    return summarize.summarize(I.corpus(spark, d), idf=corpus_idf(spark, d)).select("doc_id", "summary")


def load_first_sentences():
    """A stand-in for a user's model."""
    return lambda texts, max_length, min_length: [text.split(".")[0] for text in texts]


def joined_first_sentences(spark, d):
    """Each chunk's first sentence, joined by document: ``(doc_id, summary, summary_chunks)``."""
    first = F.split_part("chunk", F.lit("."), F.lit(1)).alias("summary")
    return summarize.join_summaries(I.chunks(spark, d).select("doc_id", "chunk_no", first))


MODEL_VIEWS = {
    "model_summaries": "SELECT doc_id, chunk_no, string_split(chunk, '.')[1] AS summary FROM chunks",
}


@query("X2", with_views("SELECT doc_id, chunk_no, summary FROM model_summaries", MODEL_VIEWS))
def model_chunk_summaries(spark, d):
    return summarize.model_summaries(I.chunks(spark, d), load_first_sentences)


@query("A17 X2", with_views(
    "SELECT doc_id, string_agg(summary, ' ' ORDER BY chunk_no) AS summary FROM model_summaries GROUP BY doc_id", MODEL_VIEWS))
def joined_model_summaries(spark, d):
    return summarize.summarize(I.corpus(spark, d), load_first_sentences).select("doc_id", "summary")


@query("F11 P19", with_views("""
    SELECT doc_id, CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS sentence_no, unnest(parts) AS sentence
    FROM (SELECT doc_id, string_split(summary, '.') AS parts
          FROM (SELECT doc_id, string_agg(summary, ' ' ORDER BY chunk_no) AS summary FROM model_summaries GROUP BY doc_id))""",
    MODEL_VIEWS))
def summary_sentences(spark, d):
    return prepare.summary_sentences(joined_first_sentences(spark, d))


@query("J3 C12", with_views("""
    SELECT q.topic_id AS doc_id, q.query_text AS content FROM queries q WHERE q.query_type = 'narrative'
    UNION ALL SELECT concat('none-', topic_id), NULL FROM topics"""))
def content_backfill(spark, d):
    """Originals in several lines per id, of which the last counts, and ids without original."""
    lines = F.when(F.col("query_type") == "narrative", 2).otherwise(1)
    originals = I.queries(spark, d).select(
        F.col("topic_id").alias("doc_id"),
        F.col("query_text").alias("content_str"),
        (lines + F.when(F.col("query_type") == "title", -1).otherwise(0)).alias("line_no"),
    )
    ids = I.topics(spark, d).select(
        F.explode(F.array("topic_id", F.concat_ws("-", F.lit("none"), "topic_id"))).alias("doc_id")
    )
    return prepare.backfill_content(ids, originals)


@query("J3", with_views("""
    SELECT c.doc_id, c.title, c.content FROM corpus c"""))
def corpus_content_backfill(spark, d):
    """Every document's content joined back to its other fields."""
    docs = I.corpus(spark, d)
    originals = docs.select("doc_id", F.col("content").alias("content_str"), F.lit(0).alias("line_no"))
    return prepare.backfill_content(docs.select("doc_id", "title"), originals)


@query("P19 C12", with_views("""
    SELECT c.doc_id, c.title, c.author, c.annotation, c.published_date, s.summary, v.n_vectors,
           round(v.total, 6) + 0.0 AS total
    FROM corpus c
    JOIN (SELECT doc_id, string_agg(summary, ' ' ORDER BY chunk_no) AS summary FROM model_summaries GROUP BY doc_id) s
      ON s.doc_id = c.doc_id
    JOIN (SELECT doc_id, CAST(count(*) AS INTEGER) AS n_vectors, sum((chunk_no + 1) * vec[1]) AS total
          FROM chunk_vectors GROUP BY doc_id) v ON v.doc_id = c.doc_id""", MODEL_VIEWS))
def prepared_records(spark, d):
    """Documents with summary and chunk vectors; the vectors are shown by count and a weighted sum."""
    docs = I.corpus(spark, d)
    summaries = joined_first_sentences(spark, d).select("doc_id", "summary")
    records = prepare.prepared_records(docs.join(summaries, "doc_id"), I.chunk_vectors(spark, d))
    parts = F.transform("summary_vector", lambda vec, i: (i + 1) * vec[0])
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return records.select(
        "doc_id", "title", "author", "annotation", "published_date", "summary",
        F.size("summary_vector").alias("n_vectors"), F.round(total, 6).alias("total"),
    )


@query("S1 S5 F21", with_views("""
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, title, author, content, annotation, published_date FROM corpus"""))
def json_lines_corpus(spark, d):
    """The corpus written as JSON lines and read back; half of it with the raw file's text key."""
    path = fresh_path(spark, "corpus")
    docs = I.corpus(spark, d)
    raw_key = F.col("doc_id") % 2 == 0
    corpus.write_corpus(
        docs.withColumn("content_str", F.when(raw_key, F.col("content"))).withColumn(
            "content", F.when(~raw_key, F.col("content"))
        ),
        path,
    )
    return corpus.read_corpus(spark, path).select(
        "doc_id", "title", "author", "content", "annotation", "published_date"
    )


@query("S1 F21", with_views("""
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(count(*) AS INTEGER) AS n_vectors, round(sum((chunk_no + 1) * vec[1]), 6) + 0.0 AS total
    FROM chunk_vectors GROUP BY doc_id"""))
def json_lines_vectors(spark, d):
    """Vectors of one chunk written flat, of several chunks nested; both read as nested arrays."""
    path = fresh_path(spark, "vectors")
    vectors = prepare.prepared_records(
        I.corpus(spark, d).withColumn("summary", F.lit("")), I.chunk_vectors(spark, d)
    ).select("doc_id", "summary_vector")
    nested = materialise(vectors, "vectors")
    corpus.write_corpus(
        nested.where(F.size("summary_vector") == 1).withColumn(
            "summary_vector", F.col("summary_vector")[0]
        ),
        f"{path}/flat",
    )
    corpus.write_corpus(nested.where(F.size("summary_vector") > 1), f"{path}/nested")
    read = corpus.read_corpus(spark, f"{path}/*")
    parts = F.transform("summary_vector", lambda vec, i: (i + 1) * vec[0])
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return read.select(
        "doc_id", F.size("summary_vector").alias("n_vectors"), F.round(total, 6).alias("total")
    )


@query("S2", with_views("SELECT topic_id, title, description, narrative FROM topics"))
def topics_file(spark, d):
    """Topics written as tagged blocks and read back."""
    path = fresh_path(spark, "topics")
    block = F.concat(
        F.lit("<top>\n<num> Number: "), "topic_id", F.lit(" </num>\n<title>\n"), "title",
        F.lit("\n</title>\n<desc> Description:\n"), "description",
        F.lit("\n</desc>\n<narr> Narrative\n"), "narrative", F.lit("\n</narr>\n</top>"),
    )
    I.topics(spark, d).select(block.alias("value")).write.option("lineSep", "\n\n").text(path)
    return topics.read_topics(spark, path)


@query("S3", with_views("""
    SELECT term, CAST(u.dim AS INTEGER) AS dim, round(vec[u.dim], 6) + 0.0 AS v
    FROM word_vectors, (SELECT unnest(generate_series(1, 64)) AS dim) u"""))
def word_vector_file(spark, d):
    """Word vectors written as text under a header line and read back."""
    path = fresh_path(spark, "word-vectors")
    lines = I.word_vectors(spark, d).select(F.concat_ws(" ", "term", F.array_join("vec", " ")).alias("value"))
    lines.write.text(path)
    header = spark.range(1).select(F.concat_ws(" ", F.lit("1000"), F.lit(str(I.DIMS))).alias("value"))
    header.write.mode("append").text(path)
    read = word_vectors.read_word_vectors(spark, path)
    exploded = read.select("term", F.posexplode("vec").alias("place", "x"))
    return exploded.select("term", (F.col("place") + 1).alias("dim"), r6("x", "v"))


def tsv(spark, path: str, schema: str):
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)


@query("S6 C9", with_views("""
    SELECT topic_id AS topic, any_value(query_text) FILTER (WHERE query_type = 'title') AS title,
           any_value(query_text) FILTER (WHERE query_type = 'narrative') AS narrative,
           any_value(query_text) FILTER (WHERE query_type = 'description') AS description
    FROM (SELECT topic_id, query_type, trim(query_text) AS query_text FROM expanded) GROUP BY topic_id""",
    chosen("first_scored")))
def expanded_queries_file(spark, d):
    path = fresh_path(spark, "expanded")
    expanded = expand(spark, d, SenseStrategy.FIRST).withColumn("query_text", F.trim("query_text"))
    reports.write_expanded_queries(expanded, path)
    return tsv(spark, path, "topic string, title string, narrative string, description string").na.fill("")


@query("S7", with_views("""
    SELECT topic_id AS topic, query_type, 'bm_25' AS approach, prec AS prec, ap AS ap, ndcg AS ndcg FROM metrics_all""", METRIC_VIEWS))
def scores_file(spark, d):
    path = fresh_path(spark, "scores")
    scores = all_metrics(spark, d).join(I.queries(spark, d), "query_id")
    reports.write_scores(
        scores.select("topic_id", "query_type", F.lit("bm_25").alias("approach"), "prec", "ap", "ndcg"), path
    )
    names = ["topic", "query_type", "approach", "prec", "ap", "ndcg"]
    read = tsv(spark, path, "a string, b string, c string, d double, e double, f double").toDF(*names)
    return read.select(*names[:3], *[r6(n) for n in names[3:]])


@query("S8 A18", with_views("""
    SELECT grade, CAST(sum(length(replace(content, chr(10) || chr(10), ''))) AS BIGINT) AS n_chars
    FROM annotated JOIN corpus USING (doc_id) WHERE topic_id = '7' GROUP BY grade"""))
def texts_by_grade_files(spark, d):
    """One folder of texts per grade, read back without the blank lines between texts."""
    path = fresh_path(spark, "texts")
    reports.write_texts_by_grade(I.corpus(spark, d), path, "7")
    read = spark.read.option("lineSep", "\n\n").schema("value string, grade int").text(path)
    return read.groupBy("grade").agg(F.sum(F.length("value")).alias("n_chars"))


@query("S9", with_views("""
    SELECT i.entity, i.class, l.label, l.description
    FROM instance_of i LEFT JOIN graph_labels l ON l.entity = i.entity"""))
def triple_files(spark, d):
    """Triple tables written as tab-separated files and read back."""
    path = fresh_path(spark, "triples")
    triples.write_triples(I.instance_of(spark, d), f"{path}/instance_of")
    triples.write_triples(I.graph_labels(spark, d), f"{path}/labels")
    members = triples.read_triples(spark, f"{path}/instance_of", triples.INSTANCE_OF)
    labels = triples.read_triples(spark, f"{path}/labels", triples.LABELS)
    return members.join(labels, "entity", "left").select("entity", "class", "label", "description")
