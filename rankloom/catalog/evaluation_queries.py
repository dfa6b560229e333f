"""Chains of several operators, end to end."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from rankloom.catalog import inputs as I
from rankloom.catalog.corpus_queries import MODEL_VIEWS, joined_first_sentences, tsv
from rankloom.catalog.expand_queries import TOKENS, chosen, expand
from rankloom.catalog.registry import query
from rankloom.catalog.search_queries import r6
from rankloom.catalog.vector_queries import GRID_VIEWS, letter_model
from rankloom.catalog.views import search_views, tok, with_views
from rankloom.operators import evaluate, prepare, search
from rankloom.operators.senses import SenseStrategy
from rankloom.plans.scratch import fresh_path
from rankloom.sources import reports


def expansion_views() -> dict[str, str]:
    """The views of each strategy under names of their own, and all their hits as ``runs``."""
    views = dict(TOKENS)
    hits = ["SELECT 'NONE' AS approach, query_id, doc_id, rank FROM top20"]
    for strategy in SenseStrategy:
        mark = strategy.value.lower()
        own = {k: v for k, v in chosen(f"{mark}_scored").items() if k not in TOKENS}
        for name, sql in own.items():
            views[f"{mark}_{name}"] = re.sub(rf"\b({'|'.join(own)})\b", rf"{mark}_\1", sql)
        views |= search_views(f"{mark}_wide", tok("content"), tok("query_text"), queries=f"{mark}_expanded")
        hits.append(f"SELECT '{strategy.value}', query_id, doc_id, rank FROM {mark}_wide_hits WHERE rank <= 20")
    names = ", ".join(f"'{name}'" for name in ("NONE", *(s.value for s in SenseStrategy)))
    grid = re.sub(r"unnest\(\[.*?\]\)", f"unnest([{names}])", GRID_VIEWS["grid"])
    return views | {k: GRID_VIEWS[k] for k in ("graded_runs", "run_metrics")} | {"runs": " UNION ALL ".join(hits), "grid": grid}


@query("C10 A8 S7 C7 C9", with_views("""
    SELECT approach, query_type, round(sum(ndcg) / (SELECT count(*) FROM topics), 6) AS mean_ndcg
    FROM grid GROUP BY approach, query_type""", expansion_views()))
def expansion_report(spark, d):
    """Expand the queries in every way, search, judge, write the scores as a file and average it."""
    queries, index = I.queries(spark, d), I.content_index(spark, d)
    runs = {"NONE": queries} | {s.value: expand(spark, d, s) for s in SenseStrategy}
    approaches = search.shared_search(index, {name: (run, "content") for name, run in runs.items()}, 20)
    scores = evaluate.score_grid(approaches, queries, index.documents, 20)
    path = fresh_path(spark, "scores")
    reports.write_scores(scores.select("topic_id", "query_type", "approach", "prec", "ap", "ndcg"), path)
    names = ["topic_id", "query_type", "approach", "prec", "ap", "ndcg"]
    read = tsv(spark, path, "a string, b string, c string, d double, e double, f double").toDF(*names)
    return evaluate.grid_report(read).select("approach", "query_type", r6("mean_ndcg"))


SENTENCE_VIEWS = MODEL_VIEWS | {
    "joined_summaries": "SELECT doc_id, string_agg(summary, ' ' ORDER BY chunk_no) AS summary FROM model_summaries GROUP BY doc_id",
    "summary_parts": """
        SELECT doc_id, CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS sentence_no, unnest(parts) AS s
        FROM (SELECT doc_id, string_split(summary, '.') AS parts FROM joined_summaries)""",
}


@query("C12 X1 F11 P19", with_views("""
    SELECT doc_id, sentence_no, CAST(length(s) AS DOUBLE) AS n, CAST(length(s) - length(replace(s, 'a', '')) AS DOUBLE) AS a,
           CAST(length(s) - length(replace(s, 'e', '')) AS DOUBLE) AS e,
           CAST(length(s) - length(replace(s, 'n', '')) AS DOUBLE) AS letter_n FROM summary_parts""", SENTENCE_VIEWS))
def summary_sentence_vectors(spark, d):
    """Each sentence of the summaries encoded by a user's model and stored by document."""
    records = prepare.encoded_summaries(joined_first_sentences(spark, d).select("doc_id", "summary"), letter_model)
    rows = records.select("doc_id", F.posexplode("summary_vector").alias("sentence_no", "vec"))
    names = ("n", "a", "e", "letter_n")
    return rows.select("doc_id", "sentence_no", *[F.col("vec")[i].alias(name) for i, name in enumerate(names)])
