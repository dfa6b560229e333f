"""Text analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.catalog import inputs as I
from rankloom.catalog.registry import query
from rankloom.catalog.views import classic, folded, norm_terms, tok, white, with_views
from rankloom.functions import text
from rankloom.operators import summarize
from rankloom.operators.phrases import canonical_terms
from rankloom.plans.joins import lookup_join
from rankloom.plans.scratch import materialise


def analysed(spark, d, analyser):
    return I.corpus(spark, d).select(
        "doc_id", F.array_join(analyser(F.col("content")), " ").alias("terms")
    )


def joined(tokens: str) -> str:
    return with_views(f"SELECT doc_id, array_to_string({tokens}, ' ') AS terms FROM corpus")


@query("F1", joined(tok("content")))
def standard_terms(spark, d):
    return analysed(spark, d, text.standard_terms)


@query("F2", joined(white("content")))
def whitespace_terms(spark, d):
    return analysed(spark, d, text.whitespace_terms)


@query("F3", joined(classic("content")))
def classic_terms(spark, d):
    return analysed(spark, d, text.classic_terms)


@query("F4", with_views(f"SELECT doc_id, {folded('lower(content)')} AS plain FROM corpus"))
def folded_text(spark, d):
    plain = text.fold_ascii(F.lower("content"))
    return I.corpus(spark, d).select("doc_id", plain.alias("plain"))


@query("F6 F8", with_views(f"""
    SELECT doc_id, array_to_string(list_concat({norm_terms('content')},
        list_filter(list_transform(regexp_split_to_array(lower(title), '\\s+'),
            lambda t: regexp_replace(t, '[^a-zA-Z0-9-]', '', 'g')), lambda t: length(t) > 1)), ' ') AS terms
    FROM corpus"""))
def normalised_terms(spark, d):
    """Tokens of the content, then of the title."""
    terms = text.normalized_terms(F.col("title"), F.col("content"))
    return I.corpus(spark, d).select("doc_id", F.array_join(terms, " ").alias("terms"))


@query("P13 U2", with_views(f"""
    SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf
    FROM (SELECT doc_id, unnest({norm_terms('content')}) AS term FROM corpus)
    WHERE term NOT IN (SELECT term FROM stopwords) GROUP BY doc_id, term"""))
def valid_tokens(spark, d):
    """Normalised tokens without stop words, counted per document."""
    terms = text.normalized_terms(F.lit(""), F.col("content")).alias("tokens")
    counted = text.count_terms(I.corpus(spark, d).select("doc_id", terms), ["doc_id"])
    return lookup_join(counted, I.stopwords(spark, d), ["term"], "left_anti").select(
        "doc_id", "term", "tf"
    )


@query("P14", with_views("""
    SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM doc_terms
    WHERE regexp_full_match(term, '\\p{L}+') AND term NOT IN (SELECT term FROM stopwords) GROUP BY doc_id"""))
def alphabetic_tokens(spark, d):
    terms = text.standard_terms(F.col("content")).alias("tokens")
    counted = text.count_terms(I.corpus(spark, d).select("doc_id", terms), ["doc_id"])
    kept = lookup_join(
        counted.where(text.alphabetic(F.col("term"))), I.stopwords(spark, d), ["term"], "left_anti"
    )
    return kept.groupBy("doc_id").agg(F.sum("tf").alias("n"))


@query("F5 F7", with_views(f"""
    SELECT doc_id, stem, CAST(sum(tf) AS BIGINT) AS tf FROM (
      SELECT doc_id, tf, CASE WHEN length(term) > 3 AND ends_with(term, 's')
                              THEN substring(term, 1, length(term) - 1) ELSE term END AS stem
      FROM (SELECT doc_id, term, count(*) AS tf
            FROM (SELECT doc_id, unnest({tok(folded('lower(content)'))}) AS term FROM corpus)
            GROUP BY doc_id, term))
    WHERE stem NOT IN (SELECT term FROM stopwords) GROUP BY doc_id, stem"""))
def stemmed_terms(spark, d):
    """Standard terms folded to ASCII, replaced by their canonical form, stop words dropped."""
    folded_terms = text.standard_terms(text.fold_ascii(F.lower("content"))).alias("tokens")
    counted = text.count_terms(I.corpus(spark, d).select("doc_id", folded_terms), ["doc_id"])
    term = F.col("term")
    plural = (F.length(term) > 3) & F.endswith(term, F.lit("s"))
    # The canonical form of each word that is not its own.
    stem = F.substring(term, F.lit(1), F.length(term) - 1)
    canonical = counted.where(plural).select("term").distinct().select("term", stem.alias("canonical"))
    found = canonical_terms(counted, materialise(canonical, "canonical"))
    kept = lookup_join(found, I.stopwords(spark, d), ["term"], "left_anti")
    return kept.select("doc_id", F.col("term").alias("stem"), "tf")


@query("P15 F18", with_views("""
    SELECT sense_id, lemma_no, replace(lemma, '_', ' ') AS lemma FROM lemmas
    WHERE len(list_filter(string_split(replace(lemma, '_', ' '), ' '), lambda w: length(w) <= 2)) = 0"""))
def valid_lemmas(spark, d):
    lemma = F.col("lemma")
    return I.lemmas(spark, d).where(text.valid_lemma(lemma)).withColumn("lemma", text.spaced(lemma))


@query("F9", with_views("SELECT doc_id, chunk_no, chunk FROM chunks"))
def document_chunks(spark, d):
    return I.chunks(spark, d)


@query("F10", with_views("SELECT doc_id, substring(content, 1, 1024) AS head FROM corpus"))
def truncated_texts(spark, d):
    return I.corpus(spark, d).select("doc_id", summarize.truncated(F.col("content")).alias("head"))


@query("F11", with_views("""
    SELECT doc_id, CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS sentence_no, unnest(parts) AS sentence
    FROM (SELECT doc_id, string_split(content, '.') AS parts FROM corpus)"""))
def sentences(spark, d):
    split = F.posexplode(summarize.sentences(F.col("content"))).alias("sentence_no", "sentence")
    return I.corpus(spark, d).select("doc_id", split)
