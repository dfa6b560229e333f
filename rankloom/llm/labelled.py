"""Bounded samples of labelled documents for training."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.plans import joins, scratch


# Texts above this share of a sample's bytes come after all others, so that none takes the room of many.
LONG_SHARE = 1 / 64


def sizes(docs: DataFrame, labels: DataFrame, label: Column, wanted: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Labels that agree, ``(doc_id, label)``, and the labelled documents with the bytes of their texts."""
    agreed = (
        labels.select("doc_id", label.alias("label"))
        .where("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("_most"))
        .where("label = _most")
        .drop("_most")
    )
    if wanted is not None:
        agreed = agreed.where(wanted)
    sized = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).alias("bytes"))
    return agreed, sized


def texts_of(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``(doc_id, text, label)`` of the few documents ``known(doc_id, label)``, one row each."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text"))


def sample(docs: DataFrame, labels: DataFrame, label: Column, rows: int, total_bytes: int, wanted: Column | None = None) -> DataFrame:
    """``(doc_id, text, label)``: whole texts of at most ``rows`` labelled documents.

    Documents are taken in the order of a hash of their id while their texts together stay within
    ``total_bytes``; those of more than ``LONG_SHARE`` of it come last, and longer ones than all of
    it are left out. Left out are also null ids, null labels and ids with contradicting labels; of
    repeated rows of a document the sample holds one.
    """
    agreed, sized = sizes(docs, labels, label, wanted)
    order = (F.col("bytes") > total_bytes * LONG_SHARE, F.xxhash64("doc_id"), F.col("doc_id"))
    measured = sized.join(agreed, "doc_id", "left_semi").groupBy("doc_id").agg(F.max("bytes").alias("bytes"))
    first = measured.where(F.col("bytes") <= total_bytes).orderBy(*order).limit(rows)
    so_far = F.sum("bytes").over(Window.orderBy(*order))
    chosen = first.withColumn("so_far", so_far).where(F.col("so_far") <= total_bytes).select("doc_id")
    # At most ``rows`` ids are broadcast.
    known = joins.broadcast_if(chosen, joins.fits(rows)).join(agreed, "doc_id")
    return texts_of(docs, known)


def sample_by_label(docs: DataFrame, labels: DataFrame, label: Column, many: int, rows: int, total_bytes: int) -> tuple[DataFrame, dict[int, int]]:
    """As ``sample``, of labels 0 to ``many`` - 1 in turn, and how many documents each label has.

    The first document of every label by hash, then the second of every label, and so on. So a rare
    label is in with as many documents as a common one, or all of its own. Of a label that has long
    texts only, one is among the first if it leaves half of the bytes to the rest.
    """
    agreed, sized = sizes(docs, labels, label, F.col("label").between(0, many - 1))
    known = scratch.materialise(sized.join(agreed, "doc_id").groupBy("doc_id", "label").agg(F.max("bytes").alias("bytes")), "labelled")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = (F.col("bytes") > total_bytes * LONG_SHARE, F.xxhash64("doc_id"), F.col("doc_id"))
    # The first rows of each label by a limit, which keeps that many in each task, too.
    firsts = [known.where((F.col("label") == i) & (F.col("bytes") <= total_bytes)).orderBy(*order).limit(rows) for i in sorted(counts)]
    if not firsts:
        return texts_of(docs, known.select("doc_id", "label")), counts
    turn = F.row_number().over(Window.partitionBy("label").orderBy(*order))
    early = (F.col("turn") == 1) & (F.col("bytes") <= total_bytes / (2 * many))
    late = (F.col("bytes") > total_bytes * LONG_SHARE) & ~early
    dealt = reduce(DataFrame.unionByName, firsts).withColumn("turn", turn).withColumn("late", late).orderBy("late", "turn", "label").limit(rows)
    so_far = F.sum("bytes").over(Window.orderBy("late", "turn", "label"))
    chosen = dealt.withColumn("so_far", so_far).where(F.col("so_far") <= total_bytes)
    return texts_of(docs, chosen.select("doc_id", "label")), counts
