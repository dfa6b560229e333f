"""Index, retrieval and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.catalog import inputs as I
from rankloom.catalog.registry import query
from rankloom.catalog.views import folded, rank, tok, with_views
from rankloom.functions import metrics
from rankloom.operators import evaluate, index, report, search
from rankloom.plans.joins import lookup_join
from rankloom.plans.scratch import materialise

METRICS_SQL = """
    SELECT query_id, count(*) AS n_hits,
           count(*) FILTER (WHERE grade = 1) AS n_grade_1, count(*) FILTER (WHERE grade = 2) AS n_grade_2,
           sum(CASE WHEN rank <= 20 AND grade > 0 THEN 1 ELSE 0 END) / 20.0 AS prec,
           CASE WHEN sum(rel) = 0 THEN 0.0 ELSE sum(CASE WHEN rel = 1 THEN found / rank ELSE 0.0 END) / sum(rel) END AS ap,
           sum(CASE WHEN rank <= 20 THEN grade / log2(rank + 1.0) ELSE 0.0 END) AS dcg,
           sum(CASE WHEN ideal <= 20 THEN grade / log2(ideal + 1.0) ELSE 0.0 END) AS best,
           sum(CASE WHEN rank <= 8 THEN grade ELSE 0 END) AS page, sum(CASE WHEN ideal <= 8 THEN grade ELSE 0 END) AS best_page
    FROM (SELECT *, CASE WHEN grade > 0 THEN 1 ELSE 0 END AS rel,
                 CAST(sum(CASE WHEN grade > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY query_id ORDER BY rank) AS DOUBLE) AS found,
                 row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, rank) AS ideal
          FROM {judged}) GROUP BY query_id"""

METRIC_VIEWS = {
    "metric_rows": METRICS_SQL.format(judged="judged"),
    "metrics_all": """
        SELECT q.query_id, q.topic_id, q.query_type, CAST(coalesce(m.n_hits, 0) AS BIGINT) AS n_hits,
               CAST(coalesce(m.n_grade_1, 0) AS BIGINT) AS n_grade_1, CAST(coalesce(m.n_grade_2, 0) AS BIGINT) AS n_grade_2,
               round(CAST(coalesce(m.prec, 0) AS DOUBLE), 6) AS prec, round(coalesce(m.ap, 0), 6) AS ap,
               round(coalesce(m.dcg, 0), 6) AS dcg,
               round(CASE WHEN coalesce(m.best, 0) = 0 THEN 0.0 ELSE m.dcg / m.best END, 6) AS ndcg,
               round(CASE WHEN coalesce(m.best_page, 0) = 0 THEN 0.0 ELSE CAST(m.page AS DOUBLE) / CAST(m.best_page AS DOUBLE) END, 6)
                   AS first_page_ratio
        FROM queries q LEFT JOIN metric_rows m ON m.query_id = q.query_id""",
}


def metric_sql(columns: str) -> str:
    return with_views(f"SELECT {columns} FROM metrics_all", METRIC_VIEWS)


def r6(name: str, alias: str | None = None):
    return F.round(F.col(name), 6).alias(alias or name)


def content_hits(spark: SparkSession, d: str, k: int = 20) -> DataFrame:
    return search.bm25_search(I.content_index(spark, d), I.queries(spark, d), "content", k)


def judged_hits(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.judge(content_hits(spark, d), I.queries(spark, d), I.content_index(spark, d).documents, 20)


def all_metrics(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.score(judged_hits(spark, d), I.queries(spark, d))


@query(
    "C1 A7",
    metric_sql("query_id, n_hits, n_grade_1, n_grade_2, prec, ap, dcg, ndcg, first_page_ratio"),
)
def bm25_evaluation(spark, d):
    names = ["prec", "ap", "dcg", "ndcg", "first_page_ratio"]
    return all_metrics(spark, d).select(
        "query_id", "n_hits", "n_grade_1", "n_grade_2", *[r6(n) for n in names]
    )


@query("A2", metric_sql("query_id, prec"))
def precision_at_k(spark, d):
    return all_metrics(spark, d).select("query_id", r6("prec"))


@query("A3", metric_sql("query_id, ap"))
def average_precision(spark, d):
    return all_metrics(spark, d).select("query_id", r6("ap"))


@query("A4 F16", metric_sql("query_id, dcg"))
def discounted_gain(spark, d):
    return all_metrics(spark, d).select("query_id", r6("dcg"))


@query("A5", metric_sql("query_id, ndcg"))
def normalised_gain(spark, d):
    return all_metrics(spark, d).select("query_id", r6("ndcg"))


@query("A6", metric_sql("query_id, first_page_ratio"))
def first_page_ratio(spark, d):
    return all_metrics(spark, d).select("query_id", r6("first_page_ratio"))


@query("A16", metric_sql("query_id, n_grade_1, n_grade_2"))
def graded_hit_counts(spark, d):
    return all_metrics(spark, d).select("query_id", "n_grade_1", "n_grade_2")


@query("A7", with_views(
    "SELECT query_id, ap, prec, ndcg FROM metrics_all WHERE n_hits > 0", METRIC_VIEWS))
def score_bundles(spark, d):
    """The metrics on relevance vectors."""
    bundle = metrics.score_bundle(F.col("relevance"), 20)
    scored = evaluate.relevance_vectors(judged_hits(spark, d), 20).select(
        "query_id", bundle.alias("s")
    )
    return scored.select("query_id", r6("s.ap", "ap"), r6("s.prec", "prec"), r6("s.ndcg", "ndcg"))


@query("A8", with_views("""
    SELECT 'bm_25' AS approach, query_type, round(sum(ndcg_raw) / (SELECT count(*) FROM topics), 6) AS mean_ndcg
    FROM (SELECT q.query_type, CASE WHEN coalesce(m.best, 0) = 0 THEN 0.0 ELSE m.dcg / m.best END AS ndcg_raw
          FROM queries q LEFT JOIN metric_rows m ON m.query_id = q.query_id) GROUP BY query_type""", METRIC_VIEWS))
def mean_gain_by_approach(spark, d):
    grid = all_metrics(spark, d).join(I.queries(spark, d), "query_id").select(
        "topic_id", "query_type", F.lit("bm_25").alias("approach"), "ndcg"
    )
    return evaluate.grid_report(grid).select("approach", "query_type", r6("mean_ndcg"))


@query("J1", with_views("""
    SELECT q.query_id, p.doc_id, count(*) AS n_terms, CAST(sum(q.qtf) AS BIGINT) AS n_query_words,
           CAST(sum(p.tf) AS BIGINT) AS n_doc_words
    FROM content_qt q JOIN content_post p ON p.term = q.term GROUP BY q.query_id, p.doc_id"""))
def term_matches(spark, d):
    """Matched terms per query and document."""
    terms = search.query_terms(I.queries(spark, d), ["content"])
    postings = I.content_index(spark, d).postings.where("field = 'content'")
    matched = lookup_join(postings, terms, ["field", "term"])
    return matched.groupBy("query_id", "doc_id").agg(
        F.count("*").alias("n_terms"),
        F.sum("qtf").alias("n_query_words"),
        F.sum("tf").alias("n_doc_words"),
    )


@query("A1", with_views("SELECT query_id, doc_id, score FROM content_scores"))
def bm25_all_scores(spark, d):
    return search.bm25_scores(I.content_index(spark, d), I.queries(spark, d), ["content"])


@query("T1 W1", with_views("SELECT query_id, doc_id, score, rank FROM top20"))
def top_hits(spark, d):
    return content_hits(spark, d)


@query("J2 P2 F17", with_views("SELECT query_id, doc_id, score, rank, grade FROM judged"))
def graded_hits(spark, d):
    return judged_hits(spark, d)


@query("J2", with_views("""
    SELECT h.query_id, h.doc_id, h.score, h.rank, coalesce(a.grade, 0) AS grade
    FROM top20 h JOIN queries q ON q.query_id = h.query_id
    LEFT JOIN qrels a ON a.doc_id = h.doc_id AND a.topic_id = q.topic_id"""))
def hits_graded_by_table(spark, d):
    judged = materialise(I.qrels(spark, d), "qrels")
    return evaluate.judge_by_table(content_hits(spark, d), I.queries(spark, d), judged)


@query("W8", with_views("""
    SELECT query_id, rank, CAST(sum(CASE WHEN grade > 0 THEN 1 ELSE 0 END)
        OVER (PARTITION BY query_id ORDER BY rank) AS BIGINT) AS found FROM judged"""))
def running_relevant_count(spark, d):
    found = F.sum(F.when(F.col("grade") > 0, 1).otherwise(0)).over(
        Window.partitionBy("query_id").orderBy("rank")
    )
    return judged_hits(spark, d).select("query_id", "rank", found.alias("found"))


@query("W9", with_views("""
    SELECT query_id, rank, grade, CAST(row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, rank) AS INTEGER) AS ideal
    FROM judged"""))
def ideal_rank(spark, d):
    order = Window.partitionBy("query_id").orderBy(F.col("grade").desc(), "rank")
    return judged_hits(spark, d).select(
        "query_id", "rank", "grade", F.row_number().over(order).alias("ideal")
    )


@query("A20 S4", with_views("""
    SELECT 'content' AS field, n_docs, round(avg_len, 6) AS avg_len FROM content_stat
    UNION ALL SELECT 'title', n_docs, round(avg_len, 6) FROM title_stat
    UNION ALL SELECT 'classic_content', n_docs, round(avg_len, 6) FROM classic_stat
    UNION ALL SELECT 'custom_content', n_docs, round(avg_len, 6) FROM custom_stat"""))
def field_statistics(spark, d):
    fields = ("content", "title", "classic_content", "custom_content")
    return I.lazy_index(spark, d, *fields).field_stats.select("field", "n_docs", r6("avg_len"))


@query("A20", with_views("""
    SELECT 'content' AS field, term, df FROM content_df UNION ALL SELECT 'title', term, df FROM title_df"""))
def term_statistics(spark, d):
    return index.term_statistics(I.lazy_index(spark, d, "content", "title").postings)


@query("C1 A20", with_views("SELECT query_id, doc_id, score, rank FROM top20"))
def search_without_stored_index(spark, d):
    """The texts are analysed with the query."""
    built = I.lazy_index(spark, d, "content")
    return search.bm25_search(built, I.queries(spark, d), "content")


@query("S4 J1", with_views("""
    SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS n_words, CAST(max(tf) AS INTEGER) AS max_tf,
           CAST(min(doc_len) AS INTEGER) AS min_len FROM content_post GROUP BY term"""))
def term_postings(spark, d):
    """The postings laid out by term: documents, words and bounds of every term, from its blocks."""
    blocks = I.content_index(spark, d).blocks.where("field = 'content'")
    words = F.aggregate("entries", F.lit(0).cast("long"), lambda s, e: s + e["tf"])
    return blocks.groupBy("term").agg(
        F.sum("n").alias("df"), F.sum(words).alias("n_words"), F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len")
    )


@query("S4", with_views("SELECT doc_id, title, annotation, length(content) AS n_chars FROM corpus"))
def stored_documents(spark, d):
    """The documents table of the stored index."""
    return I.content_index(spark, d).documents.select("doc_id", "title", "annotation", F.length("content").cast("long").alias("n_chars"))


@query("S4 A20 J1", with_views("""
    SELECT doc_id, doc_len, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_words FROM content_post GROUP BY doc_id, doc_len"""))
def stored_postings(spark, d):
    """Create the bucketed index and read it back: distinct and total words per document."""
    postings = I.content_index(spark, d).postings.where("field = 'content'")
    doc_len = F.col("doc_len").cast("long").alias("doc_len")
    return postings.groupBy("doc_id", doc_len).agg(
        F.count("*").alias("n_terms"), F.sum("tf").alias("n_words")
    )


@query("P10 F3", with_views("SELECT query_id, doc_id, score, rank FROM classic_hits WHERE rank <= 20"))
def classic_field_search(spark, d):
    field = report.tokenizer_field("classic")
    return search.bm25_search(I.content_index(spark, d, field), I.queries(spark, d), field)


@query("P10 F2", with_views("SELECT query_id, doc_id, score, rank FROM custom_hits WHERE rank <= 20"))
def whitespace_field_search(spark, d):
    field = report.tokenizer_field("whitespace")
    return search.bm25_search(I.content_index(spark, d, field), I.queries(spark, d), field)


def stem_counts(key: str, text: str, source: str) -> str:
    return f"""
        SELECT {key}, term, count(*) AS tf
        FROM (SELECT t.{key}, coalesce(c.canonical, t.term) AS term
              FROM (SELECT {key}, unnest({tok(folded(f'lower({text})'))}) AS term FROM {source}) t LEFT JOIN stem_forms c ON c.term = t.term)
        WHERE term NOT IN (SELECT term FROM stopwords) GROUP BY {key}, term"""


STEM_VIEWS = {
    "stem_forms": """
        SELECT term, substring(term, 1, length(term) - 1) AS canonical FROM bench_terms WHERE length(term) > 3 AND ends_with(term, 's')""",
    "stem_post": stem_counts("doc_id", "content", "corpus"),
    "stem_qt": stem_counts("query_id", "query_text", "queries"),
    "stem_len": "SELECT doc_id, sum(tf) AS doc_len FROM stem_post GROUP BY doc_id",
    "stem_df": "SELECT term, count(*) AS df FROM stem_post GROUP BY term",
    "stem_stat": "SELECT count(*) AS n_docs, avg(doc_len) AS avg_len FROM stem_len",
    "stem_scores": """
        SELECT q.query_id, p.doc_id,
               round(sum(q.tf * ln(1 + (s.n_docs - f.df + 0.5) / (f.df + 0.5))
                   * (p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * l.doc_len / s.avg_len)))), 6) AS score
        FROM stem_qt q JOIN stem_df f ON f.term = q.term JOIN stem_post p ON p.term = q.term
        JOIN stem_len l ON l.doc_id = p.doc_id, stem_stat s GROUP BY q.query_id, p.doc_id""",
}


@query("F5 F7 C1 P10", with_views(
    f"SELECT * FROM (SELECT query_id, doc_id, score, {rank('score')} AS rank FROM stem_scores) WHERE rank <= 20", STEM_VIEWS))
def stemmed_field_search(spark, d):
    """A field whose analyser takes word tables, which apply to its documents and to the queries."""
    return search.bm25_search(I.stemmed_index(spark, d), I.queries(spark, d), "stemmed_content")


@query("P9", with_views("""
    SELECT query_id, doc_id, score, rank FROM content_hits WHERE rank <= 20 AND NOT starts_with(query_id, '7-')
    UNION ALL SELECT query_id, doc_id, score, rank FROM title_hits WHERE rank <= 20 AND starts_with(query_id, '7-')"""))
def search_field_by_topic(spark, d):
    """One topic searches another field than the others."""
    fields = report.search_fields(I.queries(spark, d), ["7"], special="title")
    both = ["content", "title"]
    return search.bm25_search(I.content_index(spark, d, *both), fields, both)


UNION_VIEWS = {
    "both_searches": """
        SELECT query_id, doc_id, score, 1 AS s FROM top20
        UNION ALL SELECT query_id, doc_id, score, 2 FROM title_hits WHERE rank <= 20""",
    "united": "SELECT query_id, doc_id, arg_max(score, s) AS score FROM both_searches GROUP BY query_id, doc_id",
}


def united_hits(spark: SparkSession, d: str) -> DataFrame:
    queries = I.queries(spark, d)
    runs = {"content": (queries, "content"), "title": (queries, "title")}
    return search.union_hits(*search.shared_search(I.content_index(spark, d, *runs), runs).values())


@query("U1", with_views("SELECT query_id, doc_id, score FROM united", UNION_VIEWS))
def union_of_hits(spark, d):
    return united_hits(spark, d)


PAGE_VIEWS = {
    "page_hits": """
        SELECT h.query_id, h.doc_id, h.score, h.rank, c.title, substring(c.content, 1, 150) AS snippet,
               coalesce(a.grade, 0) AS grade
        FROM content_hits h JOIN queries q ON q.query_id = h.query_id JOIN corpus c ON c.doc_id = h.doc_id
        LEFT JOIN annotated a ON a.doc_id = h.doc_id AND a.topic_id = q.topic_id WHERE h.rank <= 16""",
}


@query("J10 P7", with_views(
    "SELECT query_id, doc_id, score, rank, title, snippet, grade FROM page_hits", PAGE_VIEWS))
def hits_with_title_and_snippet(spark, d):
    return report.enriched_hits(
        content_hits(spark, d, 16), I.queries(spark, d), I.content_index(spark, d).documents, 16
    )


@query("W3", with_views("SELECT query_id, doc_id, rank FROM content_hits WHERE rank BETWEEN 9 AND 16"))
def second_page(spark, d):
    return report.page(content_hits(spark, d, 16), 1).select("query_id", "doc_id", "rank")


@query("A19 W3", with_views("""
    SELECT query_id, count(*) AS n_hits, CAST(count(*) // 8 AS BIGINT) AS max_pages FROM content_hits GROUP BY query_id"""))
def result_counts(spark, d):
    """All matches of each query, and the pages they fill; no match is scored."""
    return report.with_pages(search.match_counts(I.content_index(spark, d), I.queries(spark, d)))
