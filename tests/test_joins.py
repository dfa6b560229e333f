"""Join strategies give the same rows, whichever is chosen."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from rankloom.operators import index, search
from rankloom.plans import joins, scratch


@pytest.fixture(scope="module")
def sides(spark):
    # One key holds most rows.
    left = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("term"),
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("t3", 3), ("t6", 4)], "term string, x int")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_plain_join(sides, monkeypatch, how):
    left, right = sides
    plain = left.join(right, "term", how)
    monkeypatch.setattr(joins, "SPLIT_ROWS", 100)
    split = joins.split_join(left, right, ["term"], how)
    looked_up = joins.lookup_join(left, right, ["term"], how)
    beyond = joins.lookup_join(left, right, ["term"], how, max_bytes=0)
    expected = sorted(map(tuple, plain.collect()), key=str)
    for other in (split, looked_up, beyond):
        assert sorted(map(tuple, other.select(plain.columns).collect()), key=str) == expected


def exchanges(df, name):
    """Shuffles in the physical plan whose key holds ``name``."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan")[0]
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and name in line]


def test_split_join_moves_the_rows_once_and_copies_no_rare_key(sides, monkeypatch):
    left, right = sides
    monkeypatch.setattr(joins, "SPLIT_ROWS", 100)
    counts = left.groupBy("term").agg(F.count("*").alias("rows"))
    old = left.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    left.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.split_join(left, right.where("x = 1 OR x = 3"), ["term"], counts=counts)
        joined.collect()
    finally:
        left.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(exchanges(joined, "_piece")) == 2  # one for either side
    pieces = 14  # 1333 rows of the hot key, 100 for each
    keys = left.where("term = 'hot'").select(F.pmod(F.xxhash64("doc_id"), F.lit(pieces)).alias("p"))
    assert keys.groupBy("p").count().agg(F.max("count")).first()[0] < 150


def test_the_number_of_split_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(joins, "SPLIT_ROWS", 1)
    monkeypatch.setattr(joins, "MOST_SPLIT", 4)
    left = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 100).alias("term"))
    right = spark.range(100).select(F.col("id").alias("term"))
    assert joins.split_join(left, right, ["term"]).count() == 1000


def test_tables_are_measured_by_their_values(spark):
    one_long_row = spark.createDataFrame([("x" * 5000, [1.0] * 100)], "a string, v array<double>")
    assert not joins.small_table(one_long_row, 5500) and joins.small_table(one_long_row, 7000)
    assert joins.small_table(spark.range(100), 1600) and not joins.small_table(spark.range(101), 1600)
    assert joins.small_table(spark.range(0), 0)


DOCS = [(1, "red car red"), (2, "blue car"), (3, "green tree tree tree"), (4, "")]


def test_search_is_the_same_beyond_the_broadcast_limit(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, content string")
    queries = spark.createDataFrame([("a", "red car"), ("b", "tree car car"), ("c", "none")], "query_id string, query_text string")
    built = index.build_index(docs, ["content"])
    small = search.bm25_search(built, queries).collect()
    monkeypatch.setattr(search, "small_table", lambda df: False)
    large = search.bm25_search(built, queries).collect()
    assert sorted(small) == sorted(large)
    assert {(r.query_id, r.doc_id) for r in small} == {("a", 1), ("a", 2), ("b", 1), ("b", 2), ("b", 3)}


def test_shared_folder_is_the_clusters():
    settings = {"spark.checkpoint.dir": "hdfs:///shared/"}
    context = SimpleNamespace(applicationId="app-1", master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)), sparkContext=context)
    assert scratch.shared_folder(session) == "hdfs:///shared/rankloom-app-1"
    assert scratch.fresh_path(session, "hits").startswith("hdfs:///shared/rankloom-app-1/hits-")
    settings.clear()
    with pytest.raises(ValueError):
        scratch.shared_folder(session)
    context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        scratch.shared_folder(session)


def test_materialise_keeps_schema_and_rows(spark):
    table = spark.range(5).select("id", F.array(F.lit(1.5)).alias("vec"))
    stored = scratch.materialise(table, "numbers")
    assert stored.columns == table.columns and sorted(stored.collect()) == sorted(table.collect())
