"""Adjacent-word phrases by part of speech, from a tag lexicon."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.text import alphabetic
from rankloom.plans.joins import lookup_join

# Words that never make a phrase.
BANNED = ["relevant", "document", "documents"]


def adjacent_pairs(texts: DataFrame, key: str, tokens: Column) -> DataFrame:
    """Neighbouring tokens of each text: ``(key, pos, first, second)``, paired inside the row."""
    held = texts.select(key, tokens.alias("_t"))
    pairs = F.zip_with(
        F.slice("_t", F.lit(1), F.greatest(F.size("_t") - 1, F.lit(0))),
        F.slice("_t", F.lit(2), F.greatest(F.size("_t") - 1, F.lit(0))),
        lambda a, b: F.struct(a.alias("first"), b.alias("second")),
    )
    return held.select(key, F.posexplode(pairs).alias("pos", "pair")).select(
        key, "pos", "pair.first", "pair.second"
    )


def valid_pair(first: Column, first_tag: Column, second: Column, second_tag: Column) -> Column:
    """Adjective or noun before a noun, neither of them banned."""
    banned = F.arrays_overlap(F.array(first, second), F.array(*[F.lit(w) for w in BANNED]))
    return first_tag.isin("ADJ", "NOUN") & (second_tag == "NOUN") & ~banned


def noun_pairs(texts: DataFrame, lexicon: DataFrame, key: str, tokens: Column) -> DataFrame:
    """Noun phrases of two words: ``(key, pos, first, second)``; ``lexicon(term, tag)``."""
    pairs = adjacent_pairs(texts, key, tokens)
    for side in ("first", "second"):
        tags = lexicon.select(F.col("term").alias(side), F.col("tag").alias(f"{side}_tag"))
        pairs = lookup_join(pairs, tags, [side], "inner", spread_by=F.struct(key, "pos"))
    return pairs.where(
        valid_pair(F.col("first"), F.col("first_tag"), F.col("second"), F.col("second_tag"))
    ).select(key, "pos", "first", "second")


def phrase_terms(pairs: DataFrame, stopwords: DataFrame, key: str) -> DataFrame:
    """Words of the noun phrases, stop words and words with other than letters dropped.

    ``(key, term, tf)``: the text that a tf-idf model is fitted on.
    """
    words = pairs.select(key, F.explode(F.array("first", "second")).alias("term"))
    kept = lookup_join(
        words.where(alphabetic(F.col("term"))),
        stopwords.select("term"),
        ["term"],
        "left_anti",
        spread_by=key,
    )
    return kept.groupBy(key, "term").agg(F.count("*").alias("tf"))


def canonical_terms(terms: DataFrame, canonical: DataFrame, key: str = "doc_id") -> DataFrame:
    """Terms replaced by their canonical form: ``(key, term, tf)``.

    ``terms(key, term, tf)``, ``canonical(term, canonical)``: one row for each word that is not its
    own canonical form, as a stemmer or a lemmatiser would give them.
    """
    named = lookup_join(terms, canonical.select("term", "canonical"), ["term"], "left", spread_by=key)
    return named.groupBy(key, F.coalesce("canonical", "term").alias("term")).agg(F.sum("tf").alias("tf"))
