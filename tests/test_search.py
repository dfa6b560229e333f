import math
import random
import re
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rankloom.operators import evaluate, index, report, rerank, search
from rankloom.plans.ranking import ranked
from rankloom.plans.scratch import materialise


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (9, "red car red", "cars", "690-2"),
        (10, "red car red", "cars", ""),
        (11, "blue car in the park", "Parks", "690-1"),
        (12, "tree", "red", "805-2"),
        (13, "", "", "690"),
    ]
    return spark.createDataFrame(rows, "doc_id long, content string, title string, annotation string")


def queries(spark, *rows):
    return spark.createDataFrame(rows, "query_id string, topic_id string, query_text string")


def hits_of(frame):
    return [(r.doc_id, r.rank) for r in frame.orderBy("query_id", "rank").collect()]


def test_bm25_by_hand(spark, docs):
    built = index.build_index(docs, ["content"])
    found = search.bm25_search(built, queries(spark, ("q", "690", "red red car")))
    rows = {r.doc_id: r for r in found.collect()}
    n, avg = 4, (3 + 3 + 5 + 1) / 4

    def part(df, tf, length, qtf):
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        return qtf * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / avg))

    assert rows[9].score == pytest.approx(part(2, 2, 3, 2) + part(3, 1, 3, 1), abs=1e-6)
    assert rows[11].score == pytest.approx(part(3, 1, 5, 1), abs=1e-6)
    # Equal scores: the id that is greater as a string comes first.
    assert (rows[9].rank, rows[10].rank, rows[11].rank) == (1, 2, 3)


def test_k_cuts_and_plan_limits_early(spark, docs):
    built = index.build_index(docs, ["content"])
    found = search.bm25_search(built, queries(spark, ("q", "690", "car red")), k=1)
    assert hits_of(found) == [(9, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan


def test_fields_by_query(spark, docs):
    built = index.build_index(docs, ["content", "title"])
    asked = queries(spark, ("a", "690", "red"), ("b", "1", "red"))
    with_field = report.search_fields(asked, ["1"], special="title")
    found = search.bm25_search(built, with_field, ["content", "title"])
    got = {(r.query_id, r.doc_id) for r in found.collect()}
    assert got == {("a", 9), ("a", 10), ("b", 12)}


def test_stored_index(spark, docs, tmp_path):
    for _ in range(2):  # create, then replace
        index.write_index(docs, ["content"], "stored", str(tmp_path / "index"), buckets=4)
    stored = index.read_index(spark, "stored")
    asked = queries(spark, ("q", "690", "red car"))
    found = search.bm25_search(stored, asked)
    lazy = search.bm25_search(index.build_index(docs, ["content"]), asked)
    assert sorted(found.collect()) == sorted(lazy.collect())


def test_union_keeps_each_document_once(spark):
    schema = "query_id string, doc_id long, score double, rank int"
    a = spark.createDataFrame([("q", 1, 3.0, 1), ("q", 2, 2.0, 2)], schema)
    b = spark.createDataFrame([("q", 2, 9.0, 1), ("p", 2, 1.0, 1)], schema)
    got = {(r.query_id, r.doc_id): r.score for r in search.union_hits(a, b).collect()}
    assert got == {("q", 1): 3.0, ("q", 2): 9.0, ("p", 2): 1.0}


def test_judging(spark, docs):
    asked = queries(spark, ("q", "690", "red car tree"))
    found = search.bm25_search(index.build_index(docs, ["content"]), asked)
    graded = evaluate.judge(found, asked, docs, 20)
    assert {r.doc_id: r.grade for r in graded.collect()} == {9: 2, 10: 0, 11: 1, 12: 0}
    vector = evaluate.relevance_vectors(graded, 20).first().relevance
    assert len(vector) == 4
    table = evaluate.judgments(docs)
    by_table = evaluate.judge_by_table(found, asked, table)
    assert sorted(by_table.collect()) == sorted(graded.collect())


HITS = "query_id string, doc_id long, score double, rank int"
VECS = "doc_id long, vec array<double>"


def test_rescore_reorders_the_window_only(spark):
    hits = spark.createDataFrame([("q", 1, 3.0, 1), ("q", 2, 2.0, 2), ("q", 3, 1.0, 3)], HITS)
    docs = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0])], VECS)
    query = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vec array<double>")
    got = rerank.rescore(hits, docs, query, window=2)
    assert hits_of(got) == [(2, 1), (1, 2), (3, 3)]
    assert [r.score for r in got.orderBy("rank").collect()] == [2.0, 1.0, 1.0]


def test_rescore_without_vector_keeps_the_hit(spark):
    hits = spark.createDataFrame([("q", 1, 3.0, 1), ("q", 2, 2.0, 2)], HITS)
    docs = spark.createDataFrame([(2, [0.0, 0.0])], VECS)
    query = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vec array<double>")
    got = rerank.rescore(hits, docs, query, window=2)
    assert {r.doc_id: r.score for r in got.collect()} == {1: 0.0, 2: 0.0}


def test_chunk_rerank_takes_the_best_chunk(spark):
    hits = spark.createDataFrame([("q", 1, 3.0, 1), ("q", 2, 2.0, 2), ("q", 3, 1.0, 3)], HITS)
    chunks = spark.createDataFrame(
        [(1, 0, [1.0, 0.0]), (2, 0, [0.0, 0.0]), (2, 1, [3.0, 4.0])], "doc_id long, chunk_no int, vec array<double>"
    )
    query = spark.createDataFrame([("q", [2.0, 0.0])], "query_id string, vec array<double>")
    by_dot = rerank.chunk_rerank(hits, chunks, query)
    assert hits_of(by_dot) == [(2, 1), (1, 2), (3, 3)]
    by_cosine = rerank.chunk_rerank(hits, chunks, query, "cosine")
    assert hits_of(by_cosine) == [(1, 1), (2, 2), (3, 3)]


def test_pages_partition_the_hits(spark):
    scored = spark.range(17).select(
        F.lit("q").alias("query_id"), F.col("id").alias("doc_id"), F.col("id").cast("double").alias("score")
    )
    hits = ranked(scored)
    sizes = [report.page(hits, n).count() for n in range(4)]
    assert sizes == [8, 8, 1, 0]
    counts = report.result_counts(hits).first()
    assert (counts.n_hits, counts.max_pages) == (17, 2)


def test_tokenizer_fields():
    assert report.tokenizer_field("classic") == "classic_content"
    with pytest.raises(ValueError):
        report.tokenizer_field("ngram")


def test_ordinals_follow_files_and_rows(spark, tmp_path, monkeypatch):
    folder, start = tmp_path / "t", 0
    folder.mkdir()
    for name, rows in (("a", 10), ("b", 2_990), ("c", 30_000)):
        (folder / f"part-{name}.txt").write_text("".join(f"{i}\n" for i in range(start, start + rows)))
        start += rows
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("40000", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            read = index.with_ordinal(spark.read.text(str(folder)))
            assert read.where(F.col("value").cast("long") != F.col("ordinal")).isEmpty()
            assert read.count() == start
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_hits_without_a_document_stay(spark):
    hits = spark.createDataFrame([("q", 1, 3.0, 1), ("q", 99, 2.0, 2), ("q", 2, 1.0, 3)], "query_id string, doc_id long, score double, rank int")
    queries = spark.createDataFrame([("q", "690")], "query_id string, topic_id string")
    docs = spark.createDataFrame([(1, "690-2", "t", "c"), (2, "690-1", "t", "c")], "doc_id long, annotation string, title string, content string")
    judged = evaluate.judge(hits, queries, docs).orderBy("rank").collect()
    assert [(r.doc_id, r.grade) for r in judged] == [(1, 2), (99, 0), (2, 1)]
    shown = report.enriched_hits(hits, queries, docs, 2).orderBy("rank").collect()
    assert [(r.doc_id, r.title, r.grade) for r in shown] == [(1, "t", 2), (99, None, 0)]


def test_average_precision_of_a_grid_runs_over_all_hits(spark):
    hits = spark.range(1, 31).select(
        F.lit("q").alias("query_id"), F.col("id").alias("doc_id"), (-F.col("id")).cast("double").alias("score"), F.col("id").cast("int").alias("rank")
    )
    queries = spark.createDataFrame([("q", "690", "title")], "query_id string, topic_id string, query_type string")
    docs = spark.createDataFrame([(1, "690-1"), (25, "690-2")], "doc_id long, annotation string")
    row = evaluate.score_grid({"bm": hits}, queries, docs, 20).first()
    assert row.ap == pytest.approx((1 + 2 / 25) / 2) and row.prec == pytest.approx(1 / 20)
    assert evaluate.score_grid({"bm": hits}, queries, docs, 20, depth=20).first().ap == 1.0


def test_a_stored_index_has_its_statistics(spark, tmp_path):
    docs = spark.createDataFrame([(1, "red car red"), (2, "blue car"), (3, "")], "doc_id long, content string")
    for name in ("first", "second"):  # the second build replaces the first
        index.write_index(docs, ["content"], "small_index", str(tmp_path / name), 2)
    stored = index.read_index(spark, "small_index")
    assert {(r.term, r.df) for r in stored.term_stats.collect()} == {("red", 1), ("blue", 1), ("car", 2)}
    queries = spark.createDataFrame([("a", "red car")], "query_id string, query_text string")
    lazy = search.bm25_search(index.build_index(docs, ["content"]), queries).collect()
    assert search.bm25_search(stored, queries).collect() == lazy and len(lazy) == 2
    scores = search.bm25_scores(stored, queries, ["content"])
    scores.collect()
    plan = scores._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan")[0]
    assert plan.count("small_index_forward") == 1


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A stored index of small blocks and pieces over texts with common words, copies and empty ones."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=rng.randrange(1, 40))) for _ in range(300)]
    rows = [(i, t, f"t {t[:5]}", f"7-{i % 3}") for i, t in enumerate(texts + texts[:40] + ["", "w0", "w0"])]
    docs = spark.createDataFrame(rows, "doc_id long, content string, title string, annotation string")
    patch = pytest.MonkeyPatch()
    patch.setattr(index, "BLOCK_POSTINGS", 4)
    patch.setattr(index, "PIECE_POSTINGS", 30)
    patch.setattr(index, "MOST_CUT", 1000)
    patch.setattr(index, "BITMAP_SHARE", 6)
    index.write_index(docs, ["content", "title"], "skewed", str(tmp_path_factory.mktemp("skewed")), 4, parts=8)
    patch.undo()
    asked = [(f"q{i}", "7", " ".join(rng.sample(words, n))) for i, n in enumerate([1, 1, 2, 3, 5, 9, 20, 40])]
    asked += [("twice", "7", "w0 w0 w30"), ("none", "7", "nothing here"), ("common", "7", "w0"), ("empty", "7", "")]
    return index.read_index(spark, "skewed"), queries(spark, *asked), docs


@pytest.mark.parametrize("parameters", [(1.2, 0.75), (0.9, 0.4)])
@pytest.mark.parametrize("k", [1, 5, 400])
def test_bounds_lose_no_hit(skewed, monkeypatch, k, parameters):
    stored, asked, _ = skewed
    monkeypatch.setattr(search, "EXHAUSTIVE_POSTINGS", 0)
    pruned = search.bm25_search(stored, asked, "content", k, *parameters)
    full = ranked(search.bm25_scores(stored, asked, ["content"], *parameters), k)
    assert sorted(pruned.collect()) == sorted(full.collect())


def test_large_queries_are_searched_without_broadcasts(skewed, monkeypatch):
    stored, asked, _ = skewed
    full = sorted(ranked(search.bm25_scores(stored, asked, ["content"]), 3).collect())
    counts = sorted(search.match_counts(stored, asked).collect())
    monkeypatch.setattr(search, "EXHAUSTIVE_POSTINGS", 0)
    monkeypatch.setattr(search, "small_table", lambda df: False)
    monkeypatch.setattr(search, "fits", lambda rows: False)
    assert sorted(search.bm25_search(stored, asked, "content", 3).collect()) == full
    assert sorted(search.match_counts(stored, asked).collect()) == counts


def test_match_counts(skewed):
    stored, asked, _ = skewed
    scored = search.bm25_scores(stored, asked, ["content"]).groupBy("query_id").count()
    assert sorted(search.match_counts(stored, asked).collect()) == sorted(scored.collect())
    assert stored.term_stats.where("frequent").count() < stored.term_stats.count()


def test_fields_by_query_in_a_stored_index(skewed, monkeypatch):
    stored, asked, _ = skewed
    monkeypatch.setattr(search, "EXHAUSTIVE_POSTINGS", 0)
    both = report.search_fields(asked.withColumn("topic_id", F.col("query_id")), ["q3", "q4"], special="title")
    pruned = search.bm25_search(stored, both, ["content", "title"], 4)
    full = ranked(search.bm25_scores(stored, both, ["content", "title"]), 4)
    assert sorted(pruned.collect()) == sorted(full.collect())


@pytest.mark.parametrize("k", [1, 5, 400])
@pytest.mark.parametrize("cells", [1, 100, 1 << 17])
def test_rows_are_scored_where_they_lie(skewed, monkeypatch, k, cells):
    """Beyond EXHAUSTIVE_POSTINGS, too: no posting is opened by its block, and no match is shuffled."""
    stored, asked, _ = skewed
    full = sorted(ranked(search.bm25_scores(stored, asked, ["content"]), k).collect())
    monkeypatch.setattr(search, "EXHAUSTIVE_POSTINGS", 1000)
    monkeypatch.setattr(search, "CELLS", cells)
    for step in ("_opened", "_all_scores"):
        monkeypatch.setattr(search, step, lambda *_: pytest.fail("the rows were to be scored"))
    assert sorted(search.bm25_search(stored, asked, "content", k).collect()) == full


def test_rows_of_one_id_are_scored_as_one_document(spark, tmp_path, monkeypatch):
    rows = [(1, "red car"), (1, "red"), (2, "red car park"), (None, "red tree"), (None, "car"), (3, ""), (3, "car"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, content string")
    index.write_index(docs, ["content"], "repeated_index", str(tmp_path), 2)
    stored = index.read_index(spark, "repeated_index")
    asked = spark.createDataFrame([("a", "red"), ("a", "red tree"), ("b", "car red car"), ("c", "none")], "query_id string, query_text string")
    full = {(r.query_id, r.doc_id): r for r in ranked(search.bm25_scores(stored, asked, ["content"]), 3).collect()}
    monkeypatch.setattr(search, "_opened", lambda *_: pytest.fail("the rows were to be scored"))
    found = search.bm25_search(stored, asked, "content", 3).collect()
    assert {(r.query_id, r.doc_id): r for r in found} == full and len(found) == len(full) == 6


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_search_reads_the_folders_of_its_terms(spark, skewed):
    stored, _, _ = skewed
    stats = stored.term_stats.where("field = 'content' AND term IN ('w3', 'w50')")
    wanted = materialise(
        stats.selectExpr("'q' AS query_id", "field", "part", "term", "1.0D AS weight", "9.0D AS average", "1.0D AS most"), "wanted"
    )
    rows = search._opened(stored, wanted, ["content"], True, F.lit(True), 1.2, 0.75)
    plan = plan_of(rows)
    assert plan.count("skewed_blocks") == 1 and "dynamicpruning" in plan
    assert rows.count() == stats.agg(F.sum("df")).first()[0]


def test_documents_meet_hits_in_their_buckets(spark, skewed):
    stored, asked, _ = skewed
    hits = search.bm25_search(stored, asked, "content", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(evaluate.hits_with(hits, asked, stored.documents, 3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only the hits are exchanged by document.
    assert plan.count("Exchange hashpartitioning(doc_id") == 1 and "Bucketed: true" in plan


def test_cut_terms_stay_in_bounded_blocks(skewed):
    stored, _, _ = skewed
    sizes = stored.blocks.groupBy("field", "term", "piece").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    assert sizes.agg(F.max("n"), F.max("most")).first()[1] <= 4 and sizes.where("piece > 0").count() > 0
    back = stored.blocks.select("field", "term", F.inline("entries")).select("field", "doc_id", "term", "tf", "doc_len")
    assert sorted(back.collect()) == sorted(stored.postings.collect())


def test_result_page_has_hits_and_metrics(skewed):
    stored, asked, docs = skewed
    hits = search.bm25_search(stored, asked, "content", 16)
    rows = report.result_page(hits, asked, stored.documents, 16, 4).where("query_id = 'common'").orderBy("rank").collect()
    assert [r.page for r in rows] == [i // 4 for i in range(16)] and {r.max_pages for r in rows} == {4}
    expected = evaluate.score(evaluate.judge(hits, asked, docs), asked, 4).where("query_id = 'common'").first()
    assert {r.ndcg for r in rows} == {expected.ndcg} and all(r.title.startswith("t") for r in rows)


def test_word_tables_apply_to_documents_and_queries(spark, tmp_path):
    docs = spark.createDataFrame([(1, "The cars and a car"), (2, "cars"), (3, "the the"), (4, "")], "doc_id long, content string")
    canonical = spark.createDataFrame([("stemmed_content", "cars", "car")], "field string, term string, canonical string")
    stops = spark.createDataFrame([("stemmed_content", "the"), ("stemmed_content", "a")], "field string, term string")
    fields = {"content": "content", "stemmed_content": "content"}
    index.write_index(docs, fields, "tabled", str(tmp_path / "tabled"), 2, canonical=canonical, stops=stops)
    stored = index.read_index(spark, "tabled")
    rows = stored.forward.where("field = 'stemmed_content'").orderBy("doc_id").collect()
    assert [(r.doc_len, [tuple(t) for t in r.terms]) for r in rows] == [(3, [("and", 1), ("car", 2)]), (1, [("car", 1)]), (0, []), (0, [])]
    asked = queries(spark, ("q", "1", "the CARS"))
    assert {r.doc_id for r in search.bm25_search(stored, asked, "stemmed_content").collect()} == {1, 2}
    assert {r.doc_id for r in search.bm25_search(stored, asked, "content").collect()} == {1, 2, 3}
    index.write_index(docs, ["content"], "tabled", str(tmp_path / "plain"), 2)
    assert index.read_index(spark, "tabled").canonical is None


def test_blocks_follow_impact_and_count_every_posting(spark, tmp_path, monkeypatch):
    """Blocks made of several chunks and batches: order, bounds and bitmaps agree with the postings."""
    monkeypatch.setattr(index, "BLOCK_POSTINGS", 3)
    monkeypatch.setattr(index, "CHUNK_DOCUMENTS", 2)
    rng = random.Random(8)
    rows = [(i % 50, " ".join(rng.choices(["a", "b", "é", "c"], [9, 5, 3, 1], k=rng.randrange(9)))) for i in range(70)] + [(None, "a b"), (99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, content string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    try:
        index.write_index(docs, ["content"], "chunked", str(tmp_path / "chunked"), 3)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    stored = index.read_index(spark, "chunked")
    average = stored.field_stats.first().avg_len
    held = {}
    for r in stored.blocks.orderBy("term", "block").collect():
        impact = [e.tf * 2.2 / (e.tf + 1.2 * (0.25 + 0.75 * e.doc_len / average)) for e in r.entries]
        assert (r.n, r.max_tf, r.min_len) == (len(impact), max(e.tf for e in r.entries), min(e.doc_len for e in r.entries))
        assert r.impact == pytest.approx(impact[0]) and (r.n == 3 or r.block == len(held.get(r.term, [])) // 3)
        held.setdefault(r.term, []).extend((-i, -1 if e.doc_id is None else e.doc_id) for i, e in zip(impact, r.entries))
    assert all(v == sorted(v) for v in held.values())
    assert {t: len(v) for t, v in held.items()} == {r.term: r.df for r in stored.term_stats.collect()}
    bits = stored.bitmaps.groupBy("term").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    assert {r.term: r.n for r in bits.collect()} == {r.term: r.df for r in stored.term_stats.where("frequent").collect()}


def test_buckets_follow_the_text(spark, tmp_path, monkeypatch):
    from rankloom.catalog import inputs

    spark.createDataFrame([(i, "x" * 1000, "en", "s", 1000) for i in range(100)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    assert inputs.index_buckets(spark, str(tmp_path)) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(inputs, "BUCKET_BYTES", 1000)
    assert inputs.index_buckets(spark, str(tmp_path)) == 100


def test_pairs_take_the_vectors_of_hit_documents_only(spark, monkeypatch):
    from rankloom.catalog import inputs, vector_queries

    hits = spark.createDataFrame([("q", 1), ("q", 3)], "query_id string, doc_id long")
    chunks = spark.createDataFrame([(i, [1.0, float(i)]) for i in (1, 1, 2, 3)], "doc_id long, vec array<double>")
    asked = spark.createDataFrame([("q", [0.5, 2.0])], "query_id string, vec array<double>")
    for name, frame in (("chunk_vectors", chunks), ("query_vectors", asked)):
        monkeypatch.setattr(inputs, name, lambda *_, frame=frame: frame)
    monkeypatch.setattr(inputs, "doc_vectors", inputs.doc_vectors.__wrapped__)
    monkeypatch.setattr(vector_queries, "content_hits", lambda *_: hits)
    pairs = vector_queries.vector_pairs(spark, "")
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")
    assert sorted((r.doc_id, r.b) for r in pairs.collect()) == [(1, [1.0, 1.0]), (3, [1.0, 3.0])]


def test_a_built_index_leaves_no_shuffle_files(spark, tmp_path):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        """Bytes of each shuffle's files."""
        sizes = {}
        for name in disk.getAllFiles().mkString("\n").split("\n"):
            if (found := re.search(r"/(shuffle_\d+)_", name)) and Path(name).exists():
                sizes[found[1]] = sizes.get(found[1], 0) + Path(name).stat().st_size
        return sizes

    before = shuffled()
    docs = spark.createDataFrame([(i, f"red car{i} tree") for i in range(200)], "doc_id long, content string")
    index.write_index(docs, {"content": "content", "custom_content": "content"}, "swept", str(tmp_path), 3)
    for _ in range(20):  # they are deleted in the background
        left = sum(size for name, size in shuffled().items() if name not in before)
        if left < 5_000:
            break
        time.sleep(0.1)
    # At most those of small reads: no documents and no postings.
    assert left < 5_000
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in tmp_path.glob("**/*.parquet")}
    assert codecs == {"ZSTD"}


def test_document_numbers_are_short(spark, tmp_path):
    docs = spark.createDataFrame([(i % 90 or None, f"w{i}") for i in range(200)], "doc_id long, content string")
    index.write_index(docs, ["content"], "numbered", str(tmp_path), 4)
    stored = index.read_index(spark, "numbered").documents
    rows = stored.select("doc_no").collect()
    assert len({r.doc_no for r in rows}) == 200 and max(r.doc_no for r in rows) < 4 * 200


@pytest.mark.parametrize("ids", [pa.array([7, -3, 1 << 62]), pa.array([None, 3, 3], pa.int64()), pa.array(["x", "é", None])])
def test_packed_postings_come_back(ids):
    terms, n, doc, tf = pa.array(["a", "é", "zz"]), np.array([2, 1, 1]), np.array([0, 2, 1, 0]), np.array([1, 70_000, 3, 4])
    held = (terms, n, doc, tf, np.array([5, 1 << 40, 9]), np.array([3, 4, 5]), ids)
    back = index.unpacked_postings(index.packed_postings(*held), ids.type)
    assert [list(x) for x in back] == [list(x) for x in held]


def test_postings_of_other_keys_are_packed(spark, tmp_path):
    rows = [("b", "red car"), (None, "red"), ("a", "car car"), ("é", "")]
    docs = spark.createDataFrame(rows, "doc_id string, content string")
    index.write_index(docs, ["content"], "keyed", str(tmp_path), 2)
    stored = index.read_index(spark, "keyed")
    back = stored.blocks.select("field", "term", F.inline("entries")).select("field", "doc_id", "term", "tf", "doc_len")
    assert sorted(map(str, back.collect())) == sorted(map(str, stored.postings.collect()))


def test_chunk_vectors_move_lengths_and_not_texts(spark, tmp_path):
    from rankloom.catalog import inputs

    documents = [(1, "x" * 3000, "en", "s", 3000), (2, "é", "en", "s", 1), (3, None, "en", "s", 0)]
    spark.createDataFrame(documents, inputs.SCHEMAS["documents"]).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, [float(i)], 0) for i in range(5)], inputs.SCHEMAS["embeddings"]).write.parquet(str(tmp_path / "embeddings.parquet"))
    vectors = inputs.chunk_vectors(spark, str(tmp_path))
    assert sorted((r.doc_id, r.chunk_no, *r.vec) for r in vectors.collect()) == [(1, 0, 1.0), (1, 1, 2.0), (1, 2, 3.0), (2, 0, 2.0)]
    plan = vectors._jdf.queryExecution().optimizedPlan().toString()
    assert "length(text" in plan[plan.index("RepartitionByExpression") :]
