import pytest

from rankloom.plans.scratch import materialise
from rankloom.operators import graph, phrases, senses
from rankloom.operators.expand_all import expand_queries
from rankloom.operators.senses import SenseStrategy
from rankloom.functions.text import cased_words
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def words(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "queries": frame([("q", "The bank by the river"), ("r", "the the")], "query_id string, query_text string"),
        "senses": frame([("bank", 1, 1), ("bank", 2, 2), ("river", 1, 3)], "term string, sense_rank int, sense_id int"),
        "lemmas": frame(
            [(1, 1, "bank"), (1, 2, "money_box"), (1, 3, "go_on"), (2, 1, "shore"), (3, 1, "stream")],
            "sense_id int, lemma_no int, lemma string",
        ),
        "definitions": frame(
            [(1, "place for money"), (2, "land by the river"), (3, "flowing water")], "sense_id int, definition string"
        ),
        "stopwords": frame([("the",), ("by",)], "term string"),
        "vectors": frame(
            [("river", [0.0, 1.0]), ("land", [0.0, 1.0]), ("money", [1.0, 0.0]), ("shore", [0.0, 1.0])],
            "term string, vec array<double>",
        ),
    }


@pytest.mark.parametrize(
    "strategy, added",
    [
        (SenseStrategy.FIRST, "bank money box stream"),
        (SenseStrategy.LESK, "shore stream"),
        (SenseStrategy.VECTOR, "shore stream"),
    ],
)
def test_strategies(words, strategy, added):
    expanded = senses.expand_senses(
        words["queries"], words["senses"], words["lemmas"], words["definitions"], words["stopwords"],
        strategy, words["vectors"], 2,
    )
    texts = {r.query_id: r.query_text for r in expanded.collect()}
    assert texts == {"q": "The bank by the river " + added, "r": "the the "}


def test_vector_strategy_needs_vectors(words):
    with pytest.raises(ValueError):
        senses.expand_senses(
            words["queries"], words["senses"], words["lemmas"], words["definitions"], words["stopwords"],
            SenseStrategy.VECTOR,
        )


def test_no_expander_leaves_the_queries(words):
    assert expand_queries(words["queries"]) is words["queries"]


def test_pair_filter(spark):
    texts = spark.createDataFrame([("q", "old car relevant document"), ("e", ""), ("s", "car")], "query_id string, t string")
    tags = [("old", "ADJ"), ("car", "NOUN"), ("relevant", "ADJ"), ("document", "NOUN")]
    lexicon = spark.createDataFrame(tags, "term string, tag string")
    pairs = phrases.noun_pairs(texts, lexicon, "query_id", cased_words(F.col("t")))
    assert [tuple(r) for r in pairs.collect()] == [("q", 0, "old", "car")]


def test_closure_ends_on_a_cycle(spark):
    roots = spark.createDataFrame([("p", "b")], "phrase string, class string")
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a")], "class string, parent string")
    assert {r["class"] for r in graph.subclasses(roots, edges).collect()} == {"a", "b", "c"}


def test_closure_of_a_deep_chain(spark):
    roots = spark.createDataFrame([("p", "n0")], "phrase string, class string")
    edges = spark.createDataFrame([(f"n{i + 1}", f"n{i}") for i in range(6)], "class string, parent string")
    assert graph.subclasses(roots, edges).count() == 7


def test_closure_rounds_are_the_logarithm_of_the_depth(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(graph, "materialise", lambda df, name: (stored.append(name), materialise(df, name))[1])
    roots = spark.createDataFrame([("p", "n0"), ("q", "n990")], "phrase string, class string")
    edges = spark.createDataFrame([(f"n{i + 1}", f"n{i}") for i in range(999)], "class string, parent string")
    found = graph.subclasses(roots, edges).groupBy("phrase").count().collect()
    assert {r.phrase: r["count"] for r in found} == {"p": 1000, "q": 10}
    assert stored.count("classes") - 1 <= 12


def test_only_instances_of_the_wanted_classes_move(spark):
    members = spark.range(500).select(F.format_string("Q1%04d", "id").alias("entity"), (F.col("id") % 100).cast("string").alias("class"))
    labels = spark.createDataFrame([("7", "seven", None)], "entity string, label string, description string")
    none = spark.createDataFrame([], "class string, parent string")
    found = graph.phrase_entities(spark.createDataFrame([("seven",)], "phrase string"), members, none, labels)
    assert sorted(r.entity for r in found.collect()) == [f"Q1{i:04d}" for i in range(7, 500, 100)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("row_number")


def test_large_classes_are_cut_before_the_join(spark):
    members = spark.range(500).select(F.format_string("Q1%04d", "id").alias("entity"), F.lit("Q3").alias("class"))
    labels = spark.createDataFrame([("Q3", "big class", None)], "entity string, label string, description string")
    none = spark.createDataFrame([], "class string, parent string")
    found = graph.phrase_entities(spark.createDataFrame([("big class",)], "phrase string"), members, none, labels, 50)
    assert sorted(r.entity for r in found.collect()) == [f"Q1{i:04d}" for i in range(50)]


def test_graph_expansion(spark):
    queries = spark.createDataFrame([("q", "about red cars"), ("r", "nothing")], "query_id string, query_text string")
    lexicon = spark.createDataFrame([("red", "ADJ"), ("cars", "NOUN")], "term string, tag string")
    instance_of = spark.createDataFrame([("Q5", "a"), ("Q6", "b"), ("Q7", "b")], "entity string, class string")
    subclass_of = spark.createDataFrame([("a", "b"), ("b", "a")], "class string, parent string")
    labels = spark.createDataFrame(
        [("b", "red cars", None), ("Q5", "Beetle", "small car"), ("Q6", None, "no label"), ("Q7", "Kombi", "")],
        "entity string, label string, description string",
    )
    expanded = graph.expand_graph(queries, lexicon, instance_of, subclass_of, labels)
    texts = {r.query_id: r.query_text for r in expanded.collect()}
    assert texts == {"q": "about red cars Beetle small car no label Kombi", "r": "nothing "}
    limited = graph.expand_graph(queries, lexicon, instance_of, subclass_of, labels, limit=1)
    assert {r.query_id: r.query_text for r in limited.collect()}["q"] == "about red cars Beetle small car"
