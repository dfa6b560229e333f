"""The operators' inputs, derived from the given tables."""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.text import standard_terms
from rankloom.operators.index import Index, build_index, read_index, write_index
from rankloom.operators.summarize import split_chunks
from rankloom.plans.joins import broadcast_if, lookup_join, small_table, spread
from rankloom.plans.scratch import fresh_path, materialise
from rankloom.sources.topics import topic_queries

DIMS = 64


# The given tables' schemas: no footer has to be read to plan a query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


@lru_cache
def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id")


def _count(df: DataFrame):
    return df.agg(F.count("*")).scalar()


@lru_cache
def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an annotation: empty if unlabelled, malformed for some, else topic and grade."""
    return annotated(spark, sf_dir, documents(spark, sf_dir))


def annotated(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """The corpus of ``docs(doc_id, text, source)``."""
    labels = table(spark, sf_dir, "labels").withColumn("labelled", F.lit(True))
    topic = (F.col("doc_id") % _count(table(spark, sf_dir, "benchmark"))).cast("string")
    grade = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "2")
        .when(F.col("quality") == 1, "1")
        .otherwise("0")
    )
    date = F.date_add(F.lit("2018-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    # The texts stay where they are while the labels can be broadcast.
    return docs.join(broadcast_if(labels, small_table(labels)), "doc_id", "left").select(
        "doc_id",
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("source").alias("author"),
        F.col("text").alias("content"),
        F.date_format(date, "yyyy/MM/dd").alias("published_date"),
        F.when(F.col("labelled").isNull(), "")
        .when(F.col("doc_id") % 97 == 0, topic)
        .otherwise(F.concat_ws("-", topic, grade))
        .alias("annotation"),
    )


@lru_cache
def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic per passage: its first sentence, its first line, and the whole passage."""
    text, line = F.col("text"), F.lit("\n")
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("topic_id"),
        F.trim(F.replace(F.split_part(text, F.lit("."), F.lit(1)), line, F.lit(" "))).alias("title"),
        F.trim(F.split_part(text, line, F.lit(1))).alias("description"),
        F.trim(F.replace(text, line, F.lit(" "))).alias("narrative"),
    )


@lru_cache
def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_queries(topics(spark, sf_dir))


@lru_cache
def bench_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = F.explode(F.array_distinct(standard_terms(F.col("text"))))
    return (
        table(spark, sf_dir, "benchmark")
        .select(terms.alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n_items"))
    )


@lru_cache
def stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least a quarter of the passages."""
    n_items = _count(table(spark, sf_dir, "benchmark"))
    words = bench_terms(spark, sf_dir).where(F.col("n_items") * 4 >= n_items).select("term")
    return materialise(words, "stopwords")


@lru_cache
def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec")
    )


def _n_vectors(spark: SparkSession, sf_dir: str):
    return _count(table(spark, sf_dir, "embeddings"))


@lru_cache
def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages' words, each with one of the embeddings; other words are unknown."""
    digest = F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 8), 16, 10).cast("long")
    words = (
        bench_terms(spark, sf_dir)
        .select("term", (digest % _n_vectors(spark, sf_dir)).alias("vec_id"))
        .join(embeddings(spark, sf_dir), "vec_id")
        .select("term", "vec", "vec_id")
    )
    return materialise(words, "word-vectors")


@lru_cache
def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id = F.col("topic_id").cast("long") % _n_vectors(spark, sf_dir)
    return (
        queries(spark, sf_dir)
        .select("query_id", vec_id.alias("vec_id"))
        .join(embeddings(spark, sf_dir), "vec_id")
        .select("query_id", "vec")
    )


@lru_cache
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_chunks(corpus(spark, sf_dir))


def _chunk_vector(chunk_no, spark: SparkSession, sf_dir: str):
    return ((F.col("doc_id") * 31 + chunk_no) % _n_vectors(spark, sf_dir)).alias("vec_id")


@lru_cache
def chunk_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only lengths are dealt out, not the texts.
    lengths = spread(table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("length")), "doc_id")
    numbers = F.explode(F.sequence(F.lit(0), F.floor(F.col("length") / 1024).cast("int")))
    numbered = lengths.select("doc_id", numbers.alias("chunk_no"))
    return (
        numbered.select("doc_id", "chunk_no", _chunk_vector(F.col("chunk_no"), spark, sf_dir))
        .join(embeddings(spark, sf_dir), "vec_id")
        .select("doc_id", "chunk_no", "vec")
    )


@lru_cache
def doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vector per document, the mean of its chunks' vectors."""
    total = Summarizer.sum(array_to_vector(F.col("vec").cast("array<double>")))
    sums = chunk_vectors(spark, sf_dir).groupBy("doc_id").agg(total.alias("total"), F.count("*").alias("n"))
    return sums.select("doc_id", F.transform(vector_to_array("total"), lambda x: x / F.col("n")).alias("vec"))


@lru_cache
def senses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two senses per known word."""
    both = F.array(
        F.struct(F.lit(1).alias("sense_rank"), F.col("vec_id").alias("sense_id")),
        F.struct(
            F.lit(2).alias("sense_rank"),
            ((F.col("vec_id") + 3) % _n_vectors(spark, sf_dir)).alias("sense_id"),
        ),
    )
    return word_vectors(spark, sf_dir).select("term", F.inline(both))


@lru_cache
def lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of one embedding are a sense's lemmas, some of two words."""
    grouped = word_vectors(spark, sf_dir).groupBy(F.col("vec_id").alias("sense_id")).agg(
        F.sort_array(F.collect_list("term")).alias("terms")
    )
    term = F.col("term")
    two_words = F.concat_ws("_", term, F.reverse(term))
    return grouped.select("sense_id", F.posexplode("terms").alias("place", "term")).select(
        "sense_id",
        (F.col("place") + 1).alias("lemma_no"),
        F.when(F.length(term) % 3 == 0, two_words).otherwise(term).alias("lemma"),
    )


@lru_cache
def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _n_vectors(spark, sf_dir)
    return word_vectors(spark, sf_dir).groupBy(((F.col("vec_id") + n - 1) % n).alias("sense_id")).agg(
        F.array_join(F.sort_array(F.collect_list("term")), " ").alias("definition")
    )


@lru_cache
def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.length("term") % 3
    tag = F.when(rest == 0, "NOUN").when(rest == 1, "ADJ").otherwise("OTHER")
    return bench_terms(spark, sf_dir).select("term", tag.alias("tag"))


@lru_cache
def instance_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers are instances of their nation."""

    def members(name: str, mark: str, prefix: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(mark), f"{prefix}key").alias("entity"),
            F.concat(F.lit("Q3"), f"{prefix[0]}_nationkey").alias("class"),
        )

    return members("customer", "Q1", "c_cust").unionByName(members("supplier", "Q2", "s_supp"))


@lru_cache
def subclass_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations are subclasses of their region."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("Q3"), "n_nationkey").alias("class"),
        F.concat(F.lit("Q4"), "n_regionkey").alias("parent"),
    )


@lru_cache
def kg_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def classes(name: str, mark: str) -> DataFrame:
        initial = name[0]
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(mark), f"{initial}_{name}key").alias("entity"),
            F.lit(name).alias("kind"),
            F.regexp_replace(F.lower(f"{initial}_name"), "[^a-z0-9]", "").alias("name"),
        )

    return classes("nation", "Q3").unionByName(classes("region", "Q4"))


@lru_cache
def graph_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and descriptions; some customers have no label."""
    nothing = F.lit(None).cast("string").alias("description")
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Q1"), "c_custkey").alias("entity"),
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")).alias("label"),
        F.col("c_mktsegment").alias("description"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("Q2"), "s_suppkey").alias("entity"), F.col("s_name").alias("label"), nothing
    )
    classes = kg_classes(spark, sf_dir).select(
        "entity", F.concat_ws(" ", "kind", "name").alias("label"), nothing
    )
    return customers.unionByName(suppliers).unionByName(classes)


@lru_cache
def graph_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kg_classes(spark, sf_dir).select(
        F.col("entity").alias("query_id"),
        F.concat_ws(" ", F.lit("suppliers from"), "kind", "name").alias("query_text"),
    )


@lru_cache
def graph_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(
        F.struct(F.col("name").alias("term"), F.lit("NOUN").alias("tag")),
        F.struct(F.col("kind").alias("term"), F.lit("NOUN").alias("tag")),
        F.struct(F.lit("suppliers").alias("term"), F.lit("NOUN").alias("tag")),
        F.struct(F.lit("from").alias("term"), F.lit("OTHER").alias("tag")),
    )
    return kg_classes(spark, sf_dir).select(F.inline(words)).distinct()


@lru_cache
def qrels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgments that follow the text: 2 if a document holds the passage, 1 if its longest word.

    A document that holds a passage is found through that word, by an equi join on terms, and not
    by comparing every document with every passage.
    """
    term = F.col("anchor")
    anchors = (
        table(spark, sf_dir, "benchmark")
        .select("item_id", "text", F.explode(standard_terms(F.col("text"))).alias("anchor"))
        .groupBy("item_id", "text")
        .agg(F.min(F.struct((-F.length(term)).alias("n"), term.alias("anchor")))["anchor"].alias("term"))
        .select(F.col("item_id").cast("string").alias("topic_id"), F.col("text").alias("passage"), "term")
    )
    docs = documents(spark, sf_dir).select("doc_id", "text")
    terms = docs.select(
        "doc_id", F.explode(F.array_distinct(standard_terms(F.col("text")))).alias("term")
    )
    pairs = lookup_join(terms, anchors, ["term"]).select("doc_id", "topic_id", "passage")
    grade = F.when(F.contains("text", "passage"), 2).otherwise(1)
    return pairs.join(docs, "doc_id").select("topic_id", "doc_id", grade.alias("grade"))


@lru_cache
def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text fields alone, without the annotations."""
    content = F.col("text")
    return documents(spark, sf_dir).select(
        "doc_id",
        F.split_part(content, F.lit("\n"), F.lit(1)).alias("title"),
        content.alias("content"),
        *[content.alias(f) for f in ("custom_content", "classic_content", "whitespace_content")],
    )


@lru_cache
def lazy_index(spark: SparkSession, sf_dir: str, *fields: str) -> Index:
    """Postings and statistics that are computed with each query."""
    return build_index(texts(spark, sf_dir), list(fields))


# The columns that index fields analyse, where it is not the content.
FIELDS = {"title": "title"}


# Bytes of text in one bucket of a stored index: what a task sorts does not grow with the corpus.
BUCKET_BYTES = 16 << 20


def unspread_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus for an index, which deals the documents out itself."""
    return annotated(spark, sf_dir, table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def index_buckets(spark: SparkSession, sf_dir: str) -> int:
    """Buckets of a stored index: one for each core, and more of them for a larger corpus."""
    total = table(spark, sf_dir, "documents").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, -(-total // BUCKET_BYTES))


def content_index(spark: SparkSession, sf_dir: str, *fields: str) -> Index:
    """The stored index with the named ``fields``, by default the content alone."""
    return stored_index(spark, sf_dir, *sorted(fields or ["content"]))


@lru_cache
def stored_index(spark: SparkSession, sf_dir: str, *fields: str) -> Index:
    """An index of the whole corpus, written on first use in a session and then only read."""
    path = fresh_path(spark, "index")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    sources = {f: FIELDS.get(f, "content") for f in fields}
    write_index(unspread_corpus(spark, sf_dir), sources, name, path, index_buckets(spark, sf_dir))
    return read_index(spark, name)


@lru_cache
def stemmed_index(spark: SparkSession, sf_dir: str) -> Index:
    """An index whose analyser takes the passages' plurals to their singulars and drops stop words."""
    field, term = F.lit("stemmed_content").alias("field"), F.col("term")
    plurals = bench_terms(spark, sf_dir).where((F.length(term) > 3) & F.endswith(term, F.lit("s")))
    canonical = plurals.select(field, "term", F.substring(term, F.lit(1), F.length(term) - 1).alias("canonical"))
    path = fresh_path(spark, "stemmed")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    buckets = index_buckets(spark, sf_dir)
    stops = stopwords(spark, sf_dir).select(field, "term")
    write_index(unspread_corpus(spark, sf_dir), {"stemmed_content": "content"}, name, path, buckets, canonical=canonical, stops=stops)
    return read_index(spark, name)
