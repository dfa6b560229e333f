"""Quality rules on whole texts, and the likelihood ratio of their hashed n-grams.

Two multinomials over hashed words and word pairs are counted: one over trusted documents, one over
all. A document's score is the mean over its n-grams of the logarithm of the two probabilities'
ratio; every document is kept or rejected by comparing it with one threshold. DataFrame functions
only: counting is one grouped aggregate with as many groups as buckets, everything else stays in a
document's row.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.plans import joins

WHITE_CLASS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 14
THRESHOLD = -0.15


class Model(NamedTuple):
    """Log ratios by bucket: at most ``BUCKETS`` numbers, whatever the corpus."""

    ratios: tuple[float, ...]

    def column(self) -> Column:
        # One string that the optimizer folds into an array constant.
        return F.split(F.lit(",".join(f"{r:.6f}" for r in self.ratios)), ",").cast("array<double>")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once and used many times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` in order."""
    return F.array_remove(F.split(text, WHITE_CLASS), "")


def pair_hashes(hashes: Column) -> Column:
    """A hash of each word and its follower; the last word is paired with the text's end."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1)))


def hashed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``words`` replaced by ``hashes`` and ``pairs``, each in a step of its own."""
    one = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    return one.withColumn("pairs", pair_hashes(F.col("hashes")))


def repeated_words(pairs: Column) -> Column:
    """Words that lie in a three-word window that stands twice or more in the text.

    A window is two pairs in a row; windows are compared by 64-bit hashes. Texts without a repeated
    window end at the first test.
    """
    n = F.size(pairs)
    windows = F.slice(F.transform(pairs, lambda p, i: F.xxhash64(p, F.get(pairs, i + 1))), F.lit(1), F.greatest(n - 2, F.lit(0)))

    def covered(found: Column) -> Column:
        placed = F.array_sort(F.transform(found, lambda t, i: F.struct(t.alias("t"), i.alias("i"))))

        def twice(ordered: Column) -> Column:
            same = F.filter(
                ordered,
                lambda x, j: (x["t"] == F.get(ordered, j - 1)["t"]) | (x["t"] == F.get(ordered, j + 1)["t"]),
            )
            places = F.array_sort(F.transform(same, lambda x: x["i"]))
            start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
            return F.aggregate(
                places,
                start,
                lambda a, p: F.struct((p + 3).alias("end"), (a["n"] + p + 3 - F.greatest(p, a["end"])).alias("n")),
                lambda a: a["n"],
            )

        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(let(placed, twice))

    return F.when(n < 3, F.lit(0)).otherwise(let(windows, covered)).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def fit(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> Model:
    """Count the n-grams of all ``docs(doc_id, text)`` and of those in ``trusted(doc_id)``.

    One pass over all texts; each task sums its counts by bucket before the shuffle. Add-one
    smoothing. Without any trusted n-gram all ratios are 0.
    """
    marked = joins.lookup_join(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")),
        trusted.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("trusted", F.lit(1)),
        ["doc_id"],
        "left",
    )
    grams = hashed(marked.select("trusted", words(F.col("text")).alias("words")))
    counts = (
        grams.select("trusted", F.explode(F.concat("hashes", "pairs")).alias("gram"))
        .groupBy(F.pmod("gram", F.lit(buckets)).cast("int").alias("bucket"))
        .agg(F.count("*").alias("raw"), F.count("trusted").alias("target"))
    )
    raw, target = [1] * buckets, [1] * buckets
    for row in counts.collect():  # at most ``buckets`` rows
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    all_raw, all_target = sum(raw), sum(target)
    if all_target == buckets:
        return Model((0.0,) * buckets)
    return Model(tuple(math.log(t / all_target) - math.log(r / all_raw) for t, r in zip(target, raw)))


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the columns ``keep``, the base figures, ``score`` and ``kept``.

    A null or empty text has no words, fails the base rules and scores 0. Nulls in other columns,
    repeated rows and texts of any length are taken as they are.
    """
    text = F.coalesce("text", F.lit(""))
    own = [F.col(c).alias(f"_{c}") for c in keep]
    buckets = len(model.ratios)
    rows = docs.select(
        *own,
        words(text).alias("words"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        repeated_lines(text).alias("n_dup_lines"),
    )
    rows = hashed(rows.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long")))
    h, ratios = F.col("hashes"), model.column()

    def of(value: Column) -> Column:
        return F.get(ratios, F.pmod(value, F.lit(buckets)).cast("int"))

    terms = F.zip_with("hashes", "pairs", lambda x, p: of(x) + of(p))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    n = F.size(h)
    figures = rows.select(
        *[f"_{c}" for c in keep],
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        repeated_words(F.col("pairs")).alias("n_repeat_words"),
        F.when(n > 0, total / (2 * n)).otherwise(F.lit(0.0)).alias("score"),
    )
    # Counting here keeps a filter on the result from being moved below, where it would make the
    # hashes anew for every element.
    figures = figures.observe("ngram_rules", F.count("*").alias("documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return figures.select(
        *[F.col(f"_{c}").alias(c) for c in keep],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("score") >= threshold)).alias("kept"),
        "score",
    )
