import pytest
from pyspark.sql import functions as F

from rankloom.functions import annotations, text


def terms(spark, analyser, *values):
    names = [f"c{i}" for i in range(len(values))]
    frame = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return frame.select(analyser(*[F.col(n) for n in names]).alias("t")).first().t


@pytest.mark.parametrize(
    "analyser, given, expected",
    [
        (text.standard_terms, "The U.S. didn't, naïve-ly 3.14!", ["the", "u", "s", "didn't", "naïve", "ly", "3", "14"]),
        (text.standard_terms, "", []),
        (text.whitespace_terms, "  Crème brûlée,\n Straße ", ["creme", "brulee,", "strasse"]),
        (text.classic_terms, "Mail Jo.Doe@ex-ample.org or www.ex.org. End-game", ["mail", "jo.doe@ex-ample.org", "or", "www.ex.org", "end", "game"]),
        (text.cased_words, "The Old car", ["The", "Old", "car"]),
        (text.fold_ascii, "øßæœłé", "ossaeoele"),
        (text.normalized, "U.S.", "us"),
        (text.normalized, "State-run", "state-run"),
        (text.spaced, "hot_dog", "hot dog"),
        (text.valid_lemma, "hot_dog", True),
        (text.valid_lemma, "go_on", False),
        (text.alphabetic, "abc1", False),
    ],
)
def test_analysers(spark, analyser, given, expected):
    assert terms(spark, analyser, given) == expected


def test_title_tokens_come_last_and_short_ones_go(spark):
    got = terms(spark, text.normalized_terms, "Big News", "a State-run U.S. plant")
    assert got == ["state-run", "us", "plant", "big", "news"]


def test_very_long_runs_do_not_overflow(spark):
    frame = spark.range(1).select(F.expr("repeat('a.', 200000)").alias("x"))
    assert frame.select(F.size(text.classic_terms(F.col("x")))).first()[0] == 1


def test_count_terms(spark):
    rows = [(1, ["b", "a", "b"]), (2, []), (3, None)]
    frame = spark.createDataFrame(rows, "id int, tokens array<string>")
    inner = {tuple(r) for r in text.count_terms(frame, ["id"]).collect()}
    assert inner == {(1, 3, "a", 1), (1, 3, "b", 2)}
    outer = [r.id for r in text.count_terms(frame, ["id"], outer=True).collect()]
    assert sorted(outer) == [1, 1, 2, 3]


@pytest.mark.parametrize(
    "annotation, grade",
    [("690-2", 2), ("", 0), ("690", 0), ("690-1-2", 0), ("805-2", 0), ("690-x", 0), (None, 0)],
)
def test_grades(spark, annotation, grade):
    assert terms(spark, lambda a: annotations.grade_for_topic(a, F.lit("690")), annotation) == grade


def test_topic_prefix(spark):
    frame = spark.createDataFrame([("690-2",), ("805-0",), ("69-1",), ("",), (None,)], "a string")
    kept = frame.where(annotations.has_topic_prefix(F.col("a"), ["690", "805"]))
    assert {r.a for r in kept.collect()} == {"690-2", "805-0"}
