"""BM25 retrieval over the index tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.text import analyze, count_terms, open_terms
from rankloom.operators.index import K1, B, Index, bit_of_document, saturation, with_word_tables
from rankloom.plans.joins import broadcast_if, fits, small_table, split_join
from rankloom.plans.ranking import ranked, rounded
from rankloom.plans.scratch import materialise


def query_terms(queries: DataFrame, fields: list[str], index: Index | None = None) -> DataFrame:
    """Analysed terms of the queries: ``(query_id, field, term, qtf)``.

    With an ``index`` whose fields have word tables, these are applied as they were to its documents.

    ``queries`` has ``(query_id, query_text)``. With several ``fields`` it also has ``field``,
    the field that each query searches; its analyser is applied to the query text.
    """
    text = F.col("query_text")
    if len(fields) == 1:
        tokens, field = analyze(fields[0], text), F.lit(fields[0])
    else:
        field = F.col("field")
        tokens = F.coalesce(*[F.when(field == f, analyze(f, text)) for f in fields])
    analyzed = queries.select("query_id", field.alias("field"), tokens.alias("tokens"))
    terms = count_terms(analyzed, ["query_id", "field"]).select(
        "query_id", "field", "term", F.col("tf").alias("qtf")
    )
    if index is None or index.canonical is None:
        return terms
    named = with_word_tables(terms, index.canonical, index.stops, "query_id")
    return named.groupBy("query_id", "field", "term").agg(F.sum("qtf").alias("qtf"))


def _statistic(index: Index, fields: list[str], name: str) -> Column:
    """A statistic of the row's field, one scalar subquery per field."""
    return F.coalesce(
        *[
            F.when(
                F.col("field") == f,
                index.field_stats.where(F.col("field") == f).select(name).scalar(),
            )
            for f in fields
        ]
    )


def weighted_terms(index: Index, terms: DataFrame, fields: list[str], small: bool) -> DataFrame:
    """Query terms that the index has: ``(query_id, field, term, weight)`` and the term's statistics."""
    wanted = terms.select("field", "term").distinct()
    # The query terms' row of the statistics, at most one for each of them.
    stats = index.term_stats.where(F.col("field").isin(fields)).join(broadcast_if(wanted, small), ["field", "term"], "left_semi")
    df, n_docs = F.col("df"), _statistic(index, fields, "n_docs")
    return terms.join(broadcast_if(stats, small), ["field", "term"]).withColumn(
        "weight", F.col("qtf") * F.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    ).drop("qtf")


def _bound(average: Column, k1: float, b: float) -> Column:
    """The largest saturation in a block, or of a term."""
    return F.col("impact") if (k1, b) == (K1, B) else saturation("max_tf", "min_len", average, k1, b)


def bm25_scores(
    index: Index, queries: DataFrame, fields: list[str], k1: float = K1, b: float = B
) -> DataFrame:
    """Score of every document that holds a query term: ``(query_id, doc_id, score)``.

    A word given twice in a query counts twice. The query terms are stored first, because they are
    read twice. They are broadcast if they are small; otherwise frequent terms are cut into pieces
    by document, because a common word may occur in most documents and in most queries.
    """
    terms = materialise(query_terms(queries, fields, index), "query-terms")
    small = small_table(terms)
    return _all_scores(index, weighted_terms(index, terms, fields, small), fields, small, k1, b)


def _all_scores(index: Index, known: DataFrame, fields: list[str], small: bool, k1: float, b: float) -> DataFrame:
    weights = known.select("query_id", "field", "term", "weight")
    saturated = index.postings.where(F.col("field").isin(fields)).select(
        "field", "doc_id", "term", saturation("tf", "doc_len", _statistic(index, fields, "avg_len"), k1, b).alias("saturation")
    )
    if small:
        matched = saturated.join(F.broadcast(weights), ["field", "term"])
    else:
        counts = known.select("field", "term", F.col("df").alias("rows")).distinct()
        matched = split_join(saturated, weights, ["field", "term"], counts=counts)
    return matched.groupBy("query_id", "doc_id").agg(
        rounded(F.sum(F.col("weight") * F.col("saturation"))).alias("score")
    )


def bm25_search(
    index: Index,
    queries: DataFrame,
    fields: str | list[str] = "content",
    k: int = 20,
    k1: float = K1,
    b: float = B,
) -> DataFrame:
    """The first ``k`` hits of each query: ``(query_id, doc_id, score, rank)``.

    On a stored index every document that holds a query term is scored where its forward row lies
    (:func:`scores_in_rows`); if the queries' words have very many postings, it is searched with bounds
    (:func:`pruned_scores`). The hits are the same.
    """
    fields = [fields] if isinstance(fields, str) else fields
    if index.blocks is None:
        return ranked(bm25_scores(index, queries, fields, k1, b), k)
    return ranked(pruned_scores(index, queries, fields, k, k1, b), k)


# Terms of a query whose best blocks give the first candidates, and candidates taken of them, as a
# multiple of k. A bound that is short of the threshold by less than SLACK is no reason to drop.
SEED_TERMS = 8
SEEDS = 3
SLACK = 1e-5
# The terms that are not read may add up to this share of the threshold: the lower, the more postings
# are opened and the fewer documents are scored in full.
UNREAD = 0.3
# Postings, counted for each query, up to which all matching documents are scored, and how many times as
# many if they are scored in their rows. Scores held for this at once in a task: of queries by documents,
# of postings by query words, and of the best hits so far.
EXHAUSTIVE_POSTINGS = 200_000_000
IN_ROWS = 500
CELLS, PARTS, BEST = 1 << 17, 1 << 22, 1 << 22


def pruned_scores(
    index: Index, queries: DataFrame, fields: list[str], k: int, k1: float = K1, b: float = B
) -> DataFrame:
    """Exact scores ``(query_id, doc_id, score)`` of all documents that can be among the first ``k``.

    Two phases. The best blocks of each query's weightiest terms give candidates; their exact scores
    give a threshold, at most the score of the k-th hit. Then every query ranks its terms by the most
    that they can add: the weakest ones, which together stay below the threshold, cannot make a
    document a hit by themselves and are not read. Of the others only blocks are opened that can still
    reach the threshold, and of their documents only those are scored in full that can reach it, too.

    Searches of at most ``EXHAUSTIVE_POSTINGS`` postings, counted once for each query that wants them,
    score all matching documents at once, which takes fewer steps; with a small table of query terms, up
    to ``IN_ROWS`` times as many (:func:`scores_in_rows`).

    Postings are read by the folders of the wanted terms (dynamic partition pruning); full scores come
    from the forward rows of the few documents left, in their buckets.
    """
    terms = materialise(query_terms(queries, fields, index), "query-terms")
    small = small_table(terms)
    average = _statistic(index, fields, "avg_len")
    known = materialise(weighted_terms(index, terms, fields, small), "known-terms")
    postings = known.agg(F.sum("df")).first()[0] or 0
    if small and postings <= EXHAUSTIVE_POSTINGS * IN_ROWS and can_score_in_rows(known, k):
        return scores_in_rows(index, known, fields, k, k1, b)
    if postings <= EXHAUSTIVE_POSTINGS:
        return _all_scores(index, known, fields, small, k1, b)
    known = known.withColumn("average", average)
    most = F.col("weight") * _bound(F.col("average"), k1, b)
    known = materialise(known.withColumn("most", most).drop("impact", "max_tf", "min_len", "df", "frequent"), "query-weights")

    by_weight = Window.partitionBy("query_id").orderBy(F.col("weight").desc(), "term")
    heavy = known.withColumn("place", F.row_number().over(by_weight)).where(F.col("place") <= SEED_TERMS)
    first = _opened(index, heavy, fields, small, F.col("block") == 0, k1, b)
    seeds = ranked(first.groupBy("query_id", "field", "doc_id").agg(rounded(F.sum("part_score")).alias("score")), SEEDS * k, "field")
    scores = ranked(_full_scores(index, materialise(seeds, "seeds"), known, fields, small, k1, b), k)
    thresholds = materialise(scores.where(F.col("rank") == k).select("query_id", F.col("score").alias("threshold")), "thresholds")

    weakest = Window.partitionBy("query_id").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("query_id")
    reach = F.coalesce("threshold", F.lit(0.0)) - SLACK
    bounded = known.join(broadcast_if(thresholds, small), "query_id", "left").select(
        *known.columns,
        reach.alias("reach"),
        (F.sum("most").over(whole) - F.col("most")).alias("others"),
        F.sum("most").over(weakest).alias("below"),
    )
    unread = F.col("below") < UNREAD * F.col("reach")
    bounded = bounded.withColumn("rest", F.coalesce(F.max(F.when(unread, F.col("below"))).over(whole), F.lit(0.0)))
    essential = materialise(bounded.where(~unread), "essential-terms")
    block_most = F.col("weight") * _bound(F.col("average"), k1, b)
    parts = _opened(index, essential, fields, small, block_most + F.col("others") >= F.col("reach"), k1, b)
    near = (
        parts.groupBy("query_id", "field", "doc_id")
        .agg(F.sum("part_score").alias("found"), F.first("rest").alias("rest"), F.first("reach").alias("reach"))
        .where(F.col("found") + F.col("rest") >= F.col("reach"))
        .select("query_id", "field", "doc_id")
    )
    return _full_scores(index, materialise(near, "candidates"), known, fields, small, k1, b)


def can_score_in_rows(known: DataFrame, k: int) -> bool:
    """Whether each query searches one field, and the tasks can hold the best ``k`` scores of all queries."""
    queries = known.groupBy("query_id").agg(F.count_distinct("field").alias("fields"))
    n, most, nulls = queries.agg(F.count("*"), F.max("fields"), F.count_if(F.col("query_id").isNull())).first()
    return n * k <= BEST and (most or 1) == 1 and not nulls


def scores_in_rows(index: Index, known: DataFrame, fields: list[str], k: int, k1: float, b: float) -> DataFrame:
    """Exact scores ``(query_id, doc_id, score)`` of all documents that can be among the first ``k``.

    ``known`` are the queries' weighted terms, a table that has been found small. Every document is scored
    for all queries from its forward row, and a task passes on what reaches the ``k``-th best score that it
    has seen, so neither postings nor scores of all matches are shuffled or sorted. Rows that share a
    doc_id are one document: such documents, which need the sum of several rows, are scored apart.
    """
    forward = index.forward.where(F.col("field").isin(fields))
    shared = F.count("*") > 1
    apart = forward.groupBy("field", "doc_id").agg((shared | F.col("doc_id").isNull()).alias("apart")).where("apart")
    apart = materialise(apart.select("doc_id").distinct(), "repeated")
    n_apart = apart.count()
    few, same = fits(n_apart), F.col("doc_id").eqNullSafe(F.col("_id"))
    ids = broadcast_if(apart.withColumnRenamed("doc_id", "_id"), few)
    scored = []
    for field in fields:
        own = known.where(F.col("field") == field).select("query_id", "term", "weight").toArrow().combine_chunks()
        average = index.field_stats.where(F.col("field") == field).select("avg_len").first()
        if not own.num_rows or average is None:
            continue
        rows = forward.where(F.col("field") == field).select("doc_id", "doc_len", "terms")
        single = rows.join(ids, same, "left_anti") if n_apart else rows
        kinds = [known.schema["query_id"].dataType.simpleString(), forward.schema["doc_id"].dataType.simpleString()]
        best = best_of_rows(own, average[0], k, k1, b)
        scored.append(single.mapInArrow(best, "query_id {}, doc_id {}, score double".format(*kinds)))
    if n_apart or not scored:
        joined = index._replace(postings=index.postings.join(ids, same, "left_semi"))
        scored.append(_all_scores(joined, known, fields, True, k1, b))
    return reduce(DataFrame.unionByName, scored).withColumn("score", rounded(F.col("score")))


def best_of_rows(weights: pa.Table, average: float, k: int, k1: float, b: float):
    """A function over batches of ``(doc_id, doc_len, terms)`` for :func:`scores_in_rows`.

    It gives ``(query_id, doc_id, score)`` of all documents whose score is not below the ``k``-th best
    one of the rows so far, ties included.
    """
    query, term = (weights[c].combine_chunks().dictionary_encode() for c in ("query_id", "term"))
    queries, words, n = query.dictionary, term.dictionary, len(query.dictionary)
    by_word = np.argsort(term.indices.to_numpy(), kind="stable")
    of_query, weight = query.indices.to_numpy()[by_word], weights["weight"].to_numpy()[by_word]
    sizes = np.bincount(term.indices.to_numpy(), minlength=len(words))
    first = np.cumsum(sizes) - sizes
    step = max(1, min(CELLS // n, PARTS // len(weight)))

    def scores(part: pa.RecordBatch) -> np.ndarray:
        """The score of every query, by document."""
        flat = part["terms"].flatten()
        row = np.repeat(np.arange(part.num_rows), pc.fill_null(pc.list_value_length(part["terms"]), 0).to_numpy(False))
        word = pc.fill_null(pc.index_in(pc.struct_field(flat, "term"), value_set=words), -1).to_numpy(False)
        known = np.flatnonzero(word >= 0)
        row, word, tf = row[known], word[known], pc.struct_field(flat, "tf").to_numpy(False)[known]
        length = part["doc_len"].to_numpy(False)[row]
        adds = tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / average))
        asked = sizes[word]
        entry = np.repeat(np.arange(len(word)), asked)
        place = np.arange(len(entry)) - np.repeat(np.cumsum(asked) - asked, asked) + first[word][entry]
        cell = row[entry] * n + of_query[place]
        return np.bincount(cell, weight[place] * adds[entry], part.num_rows * n).reshape(part.num_rows, n)

    def best(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.zeros((k, n))
        for batch in rows:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                found = scores(part)
                top = np.partition(np.concatenate([top, found]), len(found), axis=0)[len(found) :]
                row, of = np.nonzero((found > 0) & (found >= top.min(axis=0) - SLACK))
                if len(row):
                    columns = [queries.take(pa.array(of)), part["doc_id"].take(pa.array(row)), pa.array(found[row, of])]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "doc_id", "score"])

    return best


def _opened(
    index: Index, wanted: DataFrame, fields: list[str], small: bool, keep: Column, k1: float, b: float
) -> DataFrame:
    """Postings of the wanted terms from the blocks that ``keep`` wants, with what each adds to a score."""
    blocks = index.blocks.where(F.col("field").isin(fields)).drop("piece", "n")
    terms = wanted.where(F.col("most") > 0)
    on = ["field", "part", "term"]
    joined = blocks.join(F.broadcast(terms), on) if small else split_join(blocks, terms, on, spread_by="block")
    held = [c for c in ("rest", "reach") if c in wanted.columns]
    entries = joined.where(keep).select("query_id", "field", "weight", "average", *held, F.inline("entries"))
    return entries.select(
        "query_id", "field", "doc_id", *held, (F.col("weight") * saturation("tf", "doc_len", F.col("average"), k1, b)).alias("part_score")
    )


def _full_scores(
    index: Index, pairs: DataFrame, known: DataFrame, fields: list[str], small: bool, k1: float, b: float
) -> DataFrame:
    """Scores of the given ``pairs(query_id, field, doc_id)`` from the documents' forward rows.

    The pairs go to the documents' buckets, or are broadcast; the forward rows are not shuffled.
    """
    few = fits(pairs.count())
    weights = known.select("query_id", "term", "weight", "average")
    scored = []
    for field in fields:
        rows = index.forward.where(F.col("field") == field).select("doc_id", "doc_len", "terms")
        asked = pairs.where(F.col("field") == field).select("query_id", "doc_id")
        terms = open_terms(rows.join(broadcast_if(asked, few), "doc_id"), ["query_id", "doc_id", "doc_len"])
        on = ["query_id", "term"]
        matched = terms.join(F.broadcast(weights), on) if small else split_join(terms, weights, on)
        part = F.col("weight") * saturation("tf", "doc_len", F.col("average"), k1, b)
        scored.append(matched.groupBy("query_id", "doc_id").agg(rounded(F.sum(part)).alias("score")))
    return reduce(DataFrame.unionByName, scored)


def match_counts(index: Index, queries: DataFrame, fields: str | list[str] = "content") -> DataFrame:
    """Number of documents that hold a word of each query, unscored: ``(query_id, n_hits)``.

    From a stored index. The documents of frequent terms come as bitmaps, those of rare ones from
    their postings; they are united by query and bucket of documents, so the state is a few kilobytes
    for tens of thousands of documents.
    """
    fields = [fields] if isinstance(fields, str) else fields
    terms = materialise(query_terms(queries, fields, index), "query-terms")
    small = small_table(terms)
    known = weighted_terms(index, terms, fields, small).select("query_id", "field", "part", "term", "frequent", "weight")
    known = materialise(known, "query-weights")

    def matched(rows: DataFrame, wanted: DataFrame) -> DataFrame:
        rows, wanted, on = rows.where(F.col("field").isin(fields)), wanted.where(F.col("weight") > 0), ["field", "part", "term"]
        return rows.join(F.broadcast(wanted), on) if small else split_join(rows, wanted, on, spread_by=F.lit(0))

    maps = matched(index.bitmaps, known.where("frequent")).groupBy("query_id", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    entries = matched(index.blocks.select("field", "part", "term", "entries"), known.where("NOT frequent"))
    numbers = entries.select("query_id", F.explode("entries.doc_no").alias("doc_no")).select("query_id", *bit_of_document())
    rare = numbers.groupBy("query_id", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    united = maps.unionByName(rare).groupBy("query_id", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy("query_id").agg(F.sum(F.bitmap_count("bits")).alias("n_hits"))


def shared_search(
    index: Index, runs: dict[str, tuple[DataFrame, str]], k: int = 20
) -> dict[str, DataFrame]:
    """Several searches as one: ``runs`` maps a name to queries and the field that they search.

    All queries of all runs are searched together, so that the postings of a field are read once, and
    the hits are stored once. Returns each run's hits.
    """
    fields = sorted({field for _, field in runs.values()})
    tagged = [
        queries.select(F.concat_ws("|", F.lit(name), "query_id").alias("query_id"), "query_text", F.lit(field).alias("field"))
        for name, (queries, field) in runs.items()
    ]
    hits = materialise(bm25_search(index, reduce(DataFrame.unionByName, tagged), fields, k), "hits")

    def of(name: str) -> DataFrame:
        own = hits.where(F.startswith("query_id", F.lit(f"{name}|")))
        return own.withColumn("query_id", F.substring("query_id", len(name) + 2, 1 << 30))

    return {name: of(name) for name in runs}


def union_hits(*hits: DataFrame) -> DataFrame:
    """Hits of several searches, each document once per query, unranked.

    The score is that of the last search that found the document.
    """
    merged = hits[0].select("query_id", "doc_id", "score", F.lit(0).alias("_search"))
    for number, more in enumerate(hits[1:], 1):
        merged = merged.unionByName(
            more.select("query_id", "doc_id", "score", F.lit(number).alias("_search"))
        )
    return merged.groupBy("query_id", "doc_id").agg(F.max_by("score", "_search").alias("score"))
