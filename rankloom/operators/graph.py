"""Query expansion with a knowledge graph of instance-of and subclass-of triples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.text import cased_words
from rankloom.operators.phrases import noun_pairs
from rankloom.operators.senses import append_terms
from rankloom.plans.joins import lookup_join
from rankloom.plans.scratch import materialise


def subclasses(roots: DataFrame, subclass_of: DataFrame) -> DataFrame:
    """Every class below the roots, the roots included: ``(phrase, class)``.

    ``roots(phrase, class)``. By path doubling: each round follows steps that reach twice as far as
    those of the round before, so the rounds are the logarithm of the hierarchy's depth. A round
    without new classes ends it, also in a cycle, because the steps always include those of one edge.
    Rounds are stored in the shared folder, which keeps the plan short and survives lost executors.
    """
    steps = subclass_of.select(F.col("parent").alias("class"), F.col("class").alias("below")).where("class <> below").distinct()
    steps = materialise(steps, "steps")
    known = materialise(roots.select("phrase", "class").distinct(), "classes")
    count = known.count()
    while True:
        reached = known.join(steps, "class").select("phrase", F.col("below").alias("class"))
        known = materialise(known.union(reached).distinct(), "classes")
        before, count = count, known.count()
        if count == before:
            return known
        further = steps.join(steps.select(F.col("class").alias("below"), F.col("below").alias("end")), "below")
        further = further.select("class", F.col("end").alias("below")).where("class <> below")
        steps = materialise(steps.union(further).distinct(), "steps")


def phrase_entities(
    phrases: DataFrame,
    instance_of: DataFrame,
    subclass_of: DataFrame,
    labels: DataFrame,
    limit: int = 50,
) -> DataFrame:
    """Instances of any class below an entity that is labelled with the phrase.

    ``phrases(phrase)`` gives ``(phrase, place, entity, label, description)``, at most ``limit``
    entities per phrase by id; an entity without a label has its id as label. Instances of other
    classes are left where they are; of each class only the first ``limit`` instances by id can be
    among them, so a class with very many is cut before the join.
    """
    roots = labels.join(
        phrases.select(F.col("phrase").alias("label")).distinct(), "label", "left_semi"
    ).select(F.col("label").alias("phrase"), F.col("entity").alias("class"))
    classes = materialise(subclasses(roots, subclass_of), "phrase-classes")
    wanted = lookup_join(
        instance_of.select("class", "entity"), classes.select("class").distinct(), ["class"], "left_semi", spread_by="entity"
    )
    by_id = Window.partitionBy("class").orderBy("entity")
    first = (
        wanted.distinct()
        .withColumn("_no", F.row_number().over(by_id))
        .where(F.col("_no") <= limit)
        .drop("_no")
    )
    members = classes.join(first, "class").select("phrase", "entity").distinct()
    order = Window.partitionBy("phrase").orderBy("entity")
    kept = members.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit)
    return kept.join(labels, "entity", "left").select(
        "phrase",
        "place",
        "entity",
        F.coalesce("label", "entity").alias("label"),
        "description",
    )


def entity_terms(entities: DataFrame) -> DataFrame:
    """Labels and descriptions, without empty ones and bare entity ids.

    ``(phrase, place, part, term)``; part 0 is the label, part 1 the description.
    """
    parts = entities.select(
        "phrase", "place", F.posexplode(F.array("label", "description")).alias("part", "term")
    )
    return parts.where(
        F.col("term").isNotNull() & (F.col("term") != "") & ~F.col("term").rlike("^Q[0-9]+")
    )


def query_phrases(queries: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Two-word noun phrases of the queries: ``(query_id, pos, phrase)``."""
    pairs = noun_pairs(queries, lexicon, "query_id", cased_words(F.col("query_text")))
    return pairs.select("query_id", "pos", F.concat_ws(" ", "first", "second").alias("phrase"))


def expand_graph(
    queries: DataFrame,
    lexicon: DataFrame,
    instance_of: DataFrame,
    subclass_of: DataFrame,
    labels: DataFrame,
    limit: int = 50,
) -> DataFrame:
    """Append labels and descriptions of graph entities to the queries. Each phrase is looked up once."""
    phrases = query_phrases(queries, lexicon)
    entities = phrase_entities(phrases, instance_of, subclass_of, labels, limit)
    terms = phrases.join(entity_terms(entities), "phrase").select(
        "query_id", F.struct("pos", "place", "part").alias("place"), "term"
    )
    return append_terms(queries, terms)
