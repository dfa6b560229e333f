"""Documents, annotations and relevance statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.catalog import inputs as I
from rankloom.catalog.registry import query
from rankloom.catalog.views import with_views
from rankloom.functions import annotations
from rankloom.operators import evaluate, index, prepare, report, tfidf
from rankloom.sources import reports, topics


@query("P1 F23", with_views("""
    SELECT doc_id, title, author, content, content AS custom_content, content AS whitespace_content,
           content AS classic_content, strftime(strptime(published_date, '%Y/%m/%d'), '%Y-%m-%d') AS date, annotation
    FROM corpus"""))
def index_documents(spark, d):
    docs = index.index_documents(I.corpus(spark, d))
    return docs.withColumn("date", F.col("date").cast("string"))


@query("P2 F17", with_views("""
    SELECT doc_id, annotation, CASE WHEN contains(annotation, '-') AND split_part(annotation, '-', 1) = '7'
        THEN CAST(split_part(annotation, '-', 2) AS INTEGER) ELSE 0 END AS grade FROM corpus"""))
def annotation_grades(spark, d):
    """Every document's grade for one topic."""
    grade = annotations.grade_for_topic(F.col("annotation"), F.lit("7"))
    return I.corpus(spark, d).select("doc_id", "annotation", grade.alias("grade"))


@query("P3", with_views("""
    SELECT doc_id, annotation FROM corpus WHERE starts_with(annotation, '12-') OR starts_with(annotation, '31-')"""))
def topic_prefix_filter(spark, d):
    return prepare.take_topics(I.corpus(spark, d), ["12-", "31-"]).select("doc_id", "annotation")


@query("P4", with_views("""
    SELECT topic_id, title, description, narrative FROM topics WHERE topic_id IN ('3', '7', '31')"""))
def selected_topics(spark, d):
    return topics.select_topics(I.topics(spark, d), ["3", "7", "31"])


@query("P5 J9", with_views("SELECT query_id, topic_id, query_type, query_text FROM queries"))
def topic_queries(spark, d):
    return I.queries(spark, d)


@query("J9", with_views("""
    SELECT q.query_id, a.approach FROM queries q, (SELECT unnest(['bm_25', 'custom', 'bert', 'fast']) AS approach) a"""))
def query_approach_grid(spark, d):
    approaches = F.array(*[F.lit(a) for a in ("bm_25", "custom", "bert", "fast")])
    return I.queries(spark, d).select("query_id", F.explode(approaches).alias("approach"))


@query("P6", with_views("""
    SELECT query_id, topic_id, query_type, CASE WHEN query_type = 'title' THEN query_text ELSE 'own words' END AS query_text
    FROM queries"""))
def query_text_fallback(spark, d):
    """Requests without a query text get the topic's."""
    typed = F.when(F.col("query_type") == "title", "").otherwise("own words")
    requests = I.queries(spark, d).withColumn("query_text", typed)
    return topics.query_or_topic_text(requests, I.topics(spark, d))


@query("P7", with_views("SELECT doc_id, substring(content, 1, 150) AS snippet FROM corpus"))
def snippets(spark, d):
    return I.corpus(spark, d).select("doc_id", report.snippet(F.col("content")).alias("snippet"))


@query("P8", with_views("SELECT doc_id, title, author, published_date FROM corpus WHERE doc_id = 42"))
def document_lookup(spark, d):
    return report.document(I.corpus(spark, d), 42).select(
        "doc_id", "title", "author", "published_date"
    )


@query("P11", with_views("SELECT doc_id, topic_id, grade FROM annotated"))
def well_formed_judgments(spark, d):
    return evaluate.judgments(I.corpus(spark, d))


@query("P12 A18", with_views("SELECT grade, content FROM annotated JOIN corpus USING (doc_id) WHERE topic_id = '7'"))
def texts_of_topic_by_grade(spark, d):
    return reports.texts_by_grade(I.corpus(spark, d), "7")


@query("A18", with_views("""
    SELECT topic_id, grade, count(*) AS n_docs, CAST(sum(length(content)) AS BIGINT) AS n_chars
    FROM annotated JOIN corpus USING (doc_id) GROUP BY topic_id, grade"""))
def text_volume_by_grade(spark, d):
    docs = I.corpus(spark, d)
    judged = docs.where(annotations.well_formed(F.col("annotation"))).select(
        annotations.topic_of(F.col("annotation")).alias("topic_id"),
        annotations.grade_of(F.col("annotation")).alias("grade"),
        "content",
    )
    return judged.groupBy("topic_id", "grade").agg(
        F.count("*").alias("n_docs"), F.sum(F.length("content")).alias("n_chars")
    )


@query("A9 C11", with_views("""
    SELECT topic_id, grade, count(*) AS n_docs FROM annotated WHERE topic_id = '7' GROUP BY topic_id, grade"""))
def topic_grade_counts(spark, d):
    return report.relevance_counts(I.corpus(spark, d), "7")


@query("A10 C11", with_views("SELECT topic_id, grade, count(*) AS n_docs FROM annotated GROUP BY topic_id, grade"))
def all_grade_counts(spark, d):
    return report.relevance_counts(I.corpus(spark, d))


@query("A11 T4 C11", with_views("""
    SELECT topic_id, round(avg(CASE WHEN grade <> 0 THEN 1.0 ELSE 0.0 END), 6) AS fraction
    FROM annotated GROUP BY topic_id ORDER BY fraction DESC, topic_id"""))
def relevant_fraction(spark, d):
    return report.relevant_fraction(I.corpus(spark, d)).select(
        "topic_id", F.round("fraction", 6).alias("fraction")
    )


@query("P20", with_views("""
    SELECT doc_id, grade FROM annotated WHERE topic_id = '7' ORDER BY grade DESC, doc_id LIMIT 33"""))
def tfidf_fit_corpus(spark, d):
    return tfidf.fit_corpus(I.corpus(spark, d), "7").select("doc_id", "grade")


@query("W7", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents")
def document_ordinals(spark, d):
    """Positions in the file, whose rows are in order of id."""
    return index.with_ordinal(I.table(spark, d, "documents").select("doc_id"))
