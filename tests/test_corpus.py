import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.functions import vectors
from rankloom.operators import phrases, pooling, prepare, summarize, tfidf
from rankloom.plans import joins
from rankloom.plans.scratch import materialise
from rankloom.sources import corpus, reports, topics, triples, word_vectors


@pytest.mark.parametrize(
    "text, keep, expected",
    [
        ("", True, [""]),
        ("abc", True, ["abc"]),
        ("abcd", True, ["abcd", ""]),
        ("abcdefgh", True, ["abcd", "efgh", ""]),
        ("abcd", False, ["abcd"]),
        ("abcde", False, ["abcd", "e"]),
        ("", False, [""]),
    ],
)
def test_chunks(spark, text, keep, expected):
    docs = spark.createDataFrame([(1, text)], "doc_id long, content string")
    rows = summarize.split_chunks(docs, 4, keep).orderBy("chunk_no").collect()
    assert [r.chunk for r in rows] == expected
    assert "".join(r.chunk for r in rows) == text


def test_backfill_takes_the_last_line(spark):
    docs = spark.createDataFrame([("1",), ("2",)], "doc_id string")
    originals = spark.createDataFrame(
        [("1", "old", 3), ("1", "new", 7), ("3", "x", 1)], "doc_id string, content_str string, line_no long"
    )
    got = {r.doc_id: r.content for r in prepare.backfill_content(docs, originals).collect()}
    assert got == {"1": "new", "2": None}


def test_topics_file(spark, tmp_path):
    path = tmp_path / "topics.xml"
    path.write_text(
        "<top>\n<num> Number: 12 </num>\n<title>\nWild bees \n</title>\n<desc> Description:\nfirst line\nlast line\n</desc>\n"
        "<narr> Narrative\nAll of it. \n</narr>\n</top>\n\n"
        "<top>\n<num> Number: 13 </num>\n<title>\nOld maps\n</title>\n<desc> Description:\nd\n</desc>\n<narr> Narrative\nn\n</narr>\n</top>\n"
    )
    got = {r.topic_id: r for r in topics.read_topics(spark, str(path)).collect()}
    assert set(got) == {"12", "13"}
    assert (got["12"].title, got["12"].description, got["12"].narrative) == ("Wild bees", "last line", "All of it.")
    assert got["13"].description == "d"


def test_corpus_reader_normalises(spark, tmp_path):
    lines = [
        {"doc_id": "a", "content": "x", "summary_vector": [1.0, 2.0]},
        {"doc_id": "b", "content_str": "y", "summary_vector": [[1.0], [2.0]], "ft_vector": [3.0]},
        {"doc_id": "c"},
    ]
    path = tmp_path / "docs.jl"
    path.write_text("\n".join(json.dumps(line) for line in lines))
    got = {r.doc_id: r for r in corpus.read_corpus(spark, str(path)).collect()}
    assert got["a"].summary_vector == [[1.0, 2.0]] and got["a"].content == "x"
    assert got["b"].summary_vector == [[1.0], [2.0]] and got["b"].content == "y" and got["b"].ft_vector == [3.0]
    assert got["c"].summary_vector is None and got["c"].content is None


def test_word_vector_file(spark, tmp_path):
    (tmp_path / "v.txt").write_text("2 3\ncar 1 2 3\ntree 0.5 0 -1\n")
    got = {r.term: r.vec for r in word_vectors.read_word_vectors(spark, str(tmp_path / "v.txt")).collect()}
    assert got == {"car": [1.0, 2.0, 3.0], "tree": [0.5, 0.0, -1.0]}


def test_reports(spark, tmp_path):
    scores = spark.createDataFrame([("1", "title", "bm_25", 0.5, 0.25, 1.0)], "topic_id string, query_type string, approach string, prec double, ap double, ndcg double")
    reports.write_scores(scores.coalesce(1), str(tmp_path / "scores"))
    text = "".join(p.read_text() for p in (tmp_path / "scores").glob("*.csv"))
    assert text == "Topic\tQuery.type\tApproach\tprecision\tAvg.Precision\tNDCG\n1\ttitle\tbm_25\t0.5\t0.25\t1.0\n"
    queries = spark.createDataFrame(
        [("1", "title", "a b"), ("1", "narrative", "c"), ("1", "description", "d")], "topic_id string, query_type string, query_text string"
    )
    reports.write_expanded_queries(queries.coalesce(1), str(tmp_path / "queries"))
    text = "".join(p.read_text() for p in (tmp_path / "queries").glob("*.csv"))
    assert text == "topic\ttitle\tnarrative\tdescription\n1\ta b\tc\td\n"


def test_texts_by_grade(spark, tmp_path):
    docs = spark.createDataFrame([("690-2", "one"), ("690-2", "two"), ("690-0", "three"), ("805-2", "x"), ("690", "y")], "annotation string, content string").coalesce(1)
    reports.write_texts_by_grade(docs, str(tmp_path / "t"), "690")
    read = {p.name: "".join(f.read_text() for f in p.glob("*.txt")) for p in (tmp_path / "t").glob("grade=*")}
    assert read == {"grade=2": "one\n\ntwo\n\n", "grade=0": "three\n\n"}


def test_triples(spark, tmp_path):
    table = spark.createDataFrame([("Q1", "a", None)], triples.LABELS)
    triples.write_triples(table, str(tmp_path / "l"))
    assert triples.read_triples(spark, str(tmp_path / "l"), triples.LABELS).collect() == table.collect()


def test_cosine_of_a_zero_vector_is_null(spark):
    frame = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0], [2.0, 0.0])], "a array<double>, z array<double>, b array<double>")
    row = frame.select(vectors.cosine(F.col("a"), F.col("z")).alias("z"), vectors.cosine_plus_one(F.col("a"), F.col("b")).alias("b")).first()
    assert row.z is None and row.b == pytest.approx(2.0)


def test_mean_pooling(spark):
    texts = spark.createDataFrame([(1, "Cars and cars, unknown"), (2, "and"), (3, "")], "doc_id long, content string")
    words = spark.createDataFrame([("cars", [3.0, 0.0]), ("and", [9.0, 9.0])], "term string, vec array<double>")
    stops = spark.createDataFrame([("and",)], "term string")
    got = {r.doc_id: r.vec for r in pooling.mean_pool(texts, words, stops, 2).collect()}
    assert got == {1: [2.0, 0.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}


def test_encoder_is_called_in_batches(spark):
    def make():
        def predict(texts: np.ndarray) -> np.ndarray:
            n = len(texts.ravel())
            return np.array([[float(len(t)), float(n)] for t in texts.ravel()])

        return predict

    texts = spark.range(0, 10, 1, 1).selectExpr("repeat('a', CAST(id AS INT)) AS text")
    rows = pooling.encode(texts, make, batch_size=4).collect()
    assert [r.vec[0] for r in rows] == [float(i) for i in range(10)]
    assert max(r.vec[1] for r in rows) <= 4


def test_tfidf(spark):
    docs = spark.createDataFrame([(1, "red red car"), (2, "car"), (3, "")], "doc_id long, content string")
    terms = tfidf.term_rows(docs)
    idf = tfidf.fit_tfidf(terms, docs)
    by_term = {r.term: r for r in idf.collect()}
    assert by_term["car"].idf == pytest.approx(np.log(4 / 3) + 1) and by_term["red"].df == 1
    weights = tfidf.tfidf_weights(terms, idf)
    row = {(r.doc_id, r.term): r.weight for r in weights.collect()}
    red, car = 2 * (np.log(2) + 1), np.log(4 / 3) + 1
    assert row[(1, "red")] == pytest.approx(red / np.hypot(red, car), abs=1e-6) and row[(2, "car")] == 1.0
    assert [r.term for r in tfidf.top_keywords(weights, 1).orderBy("doc_id").collect()] == ["red", "car"]


def test_keyword_ties_go_to_the_later_term(spark):
    weights = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.5), (1, "c", 0.1)], "doc_id long, term string, weight double")
    top = tfidf.top_keywords(weights, 2).orderBy("place").collect()
    assert [r.term for r in top] == ["b", "a"]


def test_fit_corpus_prefers_the_best_grades(spark):
    docs = spark.createDataFrame([(1, "690-1"), (2, "690-2"), (3, "805-2"), (4, "690-0"), (5, "")], "doc_id long, annotation string")
    assert [r.doc_id for r in tfidf.fit_corpus(docs, "690", 2).collect()] == [2, 1]


def test_summaries(spark):
    docs = spark.createDataFrame(
        [(1, "car car. rare words here. car"), (2, "car"), (3, "")], "doc_id long, content string"
    )
    got = {r.doc_id: r.summary for r in summarize.summarize(docs).collect()}
    assert got == {1: "rare words here", 2: "car", 3: ""}
    model = summarize.summarize(docs, lambda: lambda texts, longest, shortest: [t[:3] for t in texts], k=4)
    assert {r.doc_id: r.summary for r in model.collect()}[2] == "car"
    chunks = model.where("doc_id = 1").first()
    assert chunks.summary == " ".join(chunks.summary_chunks)


def test_null_texts_have_summaries(spark):
    docs = spark.createDataFrame([(1, None), (2, "car")], "doc_id long, content string")
    assert {r.doc_id: r.summary for r in summarize.summarize(docs).collect()} == {1: "", 2: "car"}


def test_models_are_loaded_once_and_called_with_lists(spark, tmp_path):
    log = str(tmp_path / "loads")

    def load():
        with open(log, "a") as file:
            file.write("x")
        return lambda texts, longest, shortest: [f"{len(texts)}" for _ in texts]

    chunks = spark.range(0, 100, 1, 1).selectExpr("id AS doc_id", "0 AS chunk_no", "IF(id % 10 = 0, NULL, 'text') AS chunk")
    rows = summarize.model_summaries(chunks, load, batch_size=40).collect()
    assert {r.summary for r in rows if r.doc_id % 10} == {"40", "10"} and all(r.summary is None for r in rows if r.doc_id % 10 == 0)
    assert len(open(log).read()) == 1


def test_canonical_terms(spark):
    terms = spark.createDataFrame([(1, "cars", 2), (1, "car", 1), (2, "bus", 1)], "doc_id long, term string, tf int")
    canonical = spark.createDataFrame([("cars", "car")], "term string, canonical string")
    found = {(r.doc_id, r.term): r.tf for r in phrases.canonical_terms(terms, canonical).collect()}
    assert found == {(1, "car"): 3, (2, "bus"): 1}


def test_prepared_records(spark):
    docs = spark.createDataFrame([(1, "t", "a", "c", "690-1", "2001/01/01", "s. u.")], "doc_id long, title string, author string, content string, annotation string, published_date string, summary string")
    vecs = spark.createDataFrame([(1, 1, [2.0]), (1, 0, [1.0])], "doc_id long, chunk_no int, vec array<double>")
    record = prepare.prepared_records(docs, vecs).first()
    assert record.summary_vector == [[1.0], [2.0]]
    rows = prepare.summary_sentences(docs).orderBy("sentence_no").collect()
    assert [r.sentence for r in rows] == ["s", " u", ""]


def test_pooling_beyond_the_broadcast_limit(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "a", "Cars and cars, unknown"), (2, "b", "and"), (2, "c", ""), (3, "d", "cars trees")], "doc_id long, part string, content string")
    words = spark.createDataFrame([("cars", [3.0, 0.0]), ("and", [9.0, 9.0]), ("trees", [0.0, 5.0])], "term string, vec array<double>")
    stops = spark.createDataFrame([("and",)], "term string")
    keys = ["doc_id", "part"]
    local = sorted(pooling.mean_pool(texts, words, stops, 2, keys).collect())
    monkeypatch.setattr(pooling, "small_table", lambda df: False)
    assert sorted(pooling.mean_pool(texts, words, stops, 2, keys).collect()) == local
    assert [r.vec for r in local] == [[2.0, 0.0], [0.0, 0.0], [0.0, 0.0], [1.5, 2.5]]


def test_models_by_topic(spark):
    """Each topic's weights come from its own model, whatever the vocabulary's size."""
    docs = spark.createDataFrame(
        [(1, "red car", "7-2"), (2, "red tree", "7-1"), (3, "red car", "8-2"), (4, "blue", ""), (5, "red car car", "9")],
        "doc_id long, content string, annotation string",
    )
    lexicon = spark.createDataFrame([("red", "ADJ"), ("car", "NOUN"), ("tree", "NOUN")], "term string, tag string")
    stops = spark.createDataFrame([("the",)], "term string")
    models = tfidf.topic_models(docs, lexicon, stops)
    by_term = {(r.topic_id, r.term): (r.df, r.idf) for r in models.collect()}
    assert by_term[("7", "red")] == (2, 1.0) and by_term[("7", "car")] == (1, pytest.approx(np.log(3 / 2) + 1))
    assert set(by_term) == {("7", "red"), ("7", "car"), ("7", "tree"), ("8", "red"), ("8", "car")}
    first = tfidf.topic_models(docs, lexicon, stops, limit=1)
    assert {(r.topic_id, r.term) for r in first.collect()} == {("7", "red"), ("7", "car"), ("8", "red"), ("8", "car")}
    words = spark.createDataFrame([("red", [1.0, 0.0]), ("car", [0.0, 1.0]), ("tree", [1.0, 1.0])], "term string, vec array<double>")
    asked = spark.createDataFrame([("a", "7", "tree car"), ("b", "8", "tree car"), ("c", "10", "car")], "query_id string, topic_id string, query_text string")
    hits = spark.createDataFrame([(q, i) for q in "abc" for i in (1, 2, 4)], "query_id string, doc_id long")
    got = {(r.query_id, r.doc_id): r.score for r in tfidf.topic_rerank(hits, docs, asked, models, words, stops, 2, keywords=1).collect()}

    def angle(x, y):
        return pytest.approx(round(float(np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y)), 6), abs=1e-6)

    # Topic 7 knows "tree", topic 8 does not; topic 10 has no model, its texts stand alone.
    assert got[("a", 2)] == angle([5 + 0.5, 5 + 1.0], [5 + 1.0, 5 + 0.5])
    assert got[("b", 1)] == angle([0 + 0.5, 5 + 1.0], [5 + 0.5, 0 + 0.5])
    assert got[("c", 1)] == angle([0, 1.0], [0.5, 0.5]) and got[("c", 4)] is None


def test_only_rare_words_are_shuffled_beyond_the_broadcast_limit(spark, monkeypatch):
    """Weights and summaries are the same with a vocabulary beyond the limit, also without a key or with equal keys."""
    texts = [(1, "a a b. c rare"), (2, "a b c. b. two"), (2, "a other"), (None, "a c only. a"), (None, "a"), (3, ""), (4, "unseen"), (5, "a b c a")]
    docs = spark.createDataFrame(texts, "doc_id long, content string")
    idf = materialise(tfidf.fit_tfidf(tfidf.term_rows(docs), docs).where("term <> 'unseen'"), "idf")
    chunks = summarize.split_chunks(docs.where("doc_id <> 2 AND doc_id IS NOT NULL"))

    def results():
        weights = tfidf.opened_weights(tfidf.weighted_texts(tfidf.term_arrays(docs), idf, ["doc_id"]), ["doc_id"])
        return [sorted(map(str, df.collect())) for df in (weights, summarize.sentence_weights(chunks, idf))]

    small = results()
    least = joins.fitting_from(idf, ["term", "idf"], "df", 80)
    assert 1 < least <= idf.agg(F.max("df")).first()[0] and joins.fitting_from(idf, ["term", "idf"], "df") == 1
    for module in (tfidf, summarize):
        monkeypatch.setattr(module, "small_table", lambda df: False)
    for limit in (0, 80, 1 << 20):
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
        assert results() == small
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 80)
    known, rare = tfidf.with_idf(tfidf.term_rows(docs), idf, ["term"], F.col("doc_id"))
    assert {r.term for r in known.collect()} == {"a", "b", "c"} and "rare" in {r.term for r in rare.collect()}
    assert "BroadcastHashJoin" in known._jdf.queryExecution().executedPlan().toString()
