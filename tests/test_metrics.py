"""Metrics against values worked out by hand, and the two forms of each metric against each other."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankloom.functions import metrics
from rankloom.operators import evaluate


def value(spark, column, grades):
    frame = spark.createDataFrame([(grades,)], "rel array<int>")
    return frame.select(column(F.col("rel")).alias("v")).first().v


@pytest.mark.parametrize(
    "column, grades, expected",
    [
        (lambda r: metrics.precision(r, 4), [2, 0, 1, 0], 0.5),
        (lambda r: metrics.precision(r, 20), [2, 1], 0.1),
        (metrics.average_precision, [2, 0, 1, 0], (1 + 2 / 3) / 2),
        (metrics.average_precision, [0, 0], 0.0),
        (metrics.average_precision, [], 0.0),
        (metrics.dcg, [2, 0, 1], 2.5),
        (metrics.ndcg, [0, 2, 1], (2 / math.log2(3) + 0.5) / (2 + 1 / math.log2(3))),
        (metrics.ndcg, [0, 0], 0.0),
        (metrics.ndcg, [], 0.0),
        (metrics.ndcg, [2, 1, 0], 1.0),
        (metrics.first_page_ratio, [0] * 8 + [2], 0.0),
        (metrics.first_page_ratio, [1, 0, 2], 1.0),
    ],
)
def test_by_hand(spark, column, grades, expected):
    assert value(spark, column, grades) == pytest.approx(expected)


def score_of(spark, lists, k):
    rows = [(f"q{i}", r + 1, g) for i, gs in enumerate(lists) for r, g in enumerate(gs)]
    judged = spark.createDataFrame(rows, "query_id string, rank int, grade int")
    queries = spark.createDataFrame([(f"q{i}",) for i in range(len(lists))], "query_id string")
    return {r.query_id: r for r in evaluate.score(judged, queries, k).collect()}


def test_query_without_hits_scores_zero(spark):
    scored = score_of(spark, [[2], []], 20)["q1"]
    assert (scored.prec, scored.ap, scored.ndcg, scored.first_page_ratio) == (0, 0, 0, 0)
    assert scored.n_hits == 0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=30), min_size=5, max_size=20))
def test_table_form_agrees_with_array_form(spark, lists):
    scored = score_of(spark, lists, 10)
    frame = spark.createDataFrame(list(enumerate(lists)), "i int, rel array<int>")
    rel = F.col("rel")
    arrays = frame.select(
        "i",
        metrics.score_bundle(rel, 10).alias("s"),
        metrics.dcg(rel, 10).alias("dcg"),
        metrics.first_page_ratio(rel).alias("page"),
    ).collect()
    for row in arrays:
        table = scored[f"q{row.i}"]
        assert table.prec == pytest.approx(row.s.prec)
        assert table.ap == pytest.approx(row.s.ap)
        assert table.ndcg == pytest.approx(row.s.ndcg)
        assert table.dcg == pytest.approx(row.dcg)
        assert table.first_page_ratio == pytest.approx(row.page)
        assert 0 <= table.ndcg <= 1 + 1e-9


def test_grid_report_divides_by_topics(spark):
    rows = [("1", "title", "a", 0.5), ("2", "title", "a", 0.0), ("1", "title", "b", 1.0)]
    grid = spark.createDataFrame(rows, "topic_id string, query_type string, approach string, ndcg double")
    means = {r.approach: r.mean_ndcg for r in evaluate.grid_report(grid).collect()}
    assert means == {"a": 0.25, "b": 0.5}
