"""The inverted index as tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rankloom.functions.text import analyze, open_terms, term_counts
from rankloom.plans.joins import lookup_join
from rankloom.plans.scratch import shuffles_dropped

PARTS = ("documents", "forward", "blocks", "bitmaps", "field_stats", "term_stats")
# Postings of one block, and of one piece of a term: a term with more is cut by document. The limit rises
# with the index, beyond ``MOST_CUT`` pieces' worth of postings.
BLOCK_POSTINGS = 256
PIECE_POSTINGS = 1_000_000
MOST_CUT = 100_000
# Documents whose postings a task turns by term at once.
CHUNK_DOCUMENTS = 4_000
POSTING = ["doc_id", "doc_no", "tf", "doc_len"]
# How the tables of a stored index are written.
STORED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6", "parquet.writer.version": "v2"}


# A term of at least one in so many documents of a field also has bitmaps. Such terms are few: at most
# this number times the distinct terms of a mean document.
BITMAP_SHARE = 64
# The usual parameters of BM25, under which impacts are stored.
K1, B = 1.2, 0.75


class Index(NamedTuple):
    """An index as tables.

    ``postings(field, doc_id, term, tf, doc_len)``, ``field_stats(field, n_docs, avg_len)`` and
    ``term_stats(field, term, df)``. A stored index also has:

    * ``documents``: the stored columns of every document and its number ``doc_no``, bucketed and
      sorted by ``doc_id``;
    * ``forward(field, doc_id, doc_no, doc_len, terms)``: each document's terms, in the same buckets;
      ``postings`` are these rows opened;
    * ``bitmaps(field, part, term, bucket, bits)``: for frequent terms the numbers of their documents,
      in the layout of Spark's bitmap functions;
    * ``blocks(field, part, piece, term, block, n, impact, max_tf, min_len, entries)``: the postings by
      term, partitioned by field and ``part``, a hash of the term. A block holds up to
      ``BLOCK_POSTINGS`` documents of one term, those that it says most about first. ``impact`` is the
      largest saturation (what a query word of weight 1 adds) under the usual parameters, ``max_tf``
      and ``min_len`` bound it under any;
    * if fields have word tables, ``canonical(field, term, canonical)`` and ``stops(field, term)``: what
      the analyser does with terms, to documents and queries alike (:func:`with_word_tables`);
    * in ``term_stats`` each term's ``part``, whether it is ``frequent``, and the same bounds of all its
      blocks.
    """

    postings: DataFrame
    field_stats: DataFrame
    term_stats: DataFrame
    documents: DataFrame | None = None
    forward: DataFrame | None = None
    blocks: DataFrame | None = None
    bitmaps: DataFrame | None = None
    canonical: DataFrame | None = None
    stops: DataFrame | None = None


def index_documents(corpus: DataFrame) -> DataFrame:
    """Raw documents in the index schema, the content repeated for each analysed field."""
    content = F.col("content")
    return corpus.select(
        "doc_id",
        "title",
        "author",
        content,
        content.alias("custom_content"),
        content.alias("whitespace_content"),
        content.alias("classic_content"),
        F.to_date("published_date", "yyyy/MM/dd").alias("date"),
        "annotation",
        *[c for c in ("summary", "summary_vector") if c in corpus.columns],
    )


def sources_of(fields: list[str] | dict[str, str]) -> dict[str, str]:
    """The column that each index field analyses: its own, unless ``fields`` maps it to another."""
    return fields if isinstance(fields, dict) else {f: f for f in fields}


def analyzed_fields(docs: DataFrame, fields: list[str] | dict[str, str], *keep: str) -> DataFrame:
    """``(field, doc_id, *keep, tokens)``; one scan of the documents serves all fields."""
    tokens = F.array(
        *[
            F.struct(F.lit(f).alias("field"), analyze(f, F.col(column)).alias("tokens"))
            for f, column in sources_of(fields).items()
        ]
    )
    return docs.select("doc_id", *keep, F.inline(tokens)).select("field", "doc_id", *keep, "tokens")


def forward_rows(docs: DataFrame, fields: list[str] | dict[str, str], *keep: str) -> DataFrame:
    """``(field, doc_id, *keep, doc_len, terms)``: the distinct terms of each field of each document.

    Counted inside each document's row, without a shuffle.
    """
    counted = term_counts(analyzed_fields(docs, fields, *keep), ["field", "doc_id", *keep])
    return counted.select("field", "doc_id", *keep, F.col("n_tokens").alias("doc_len"), "terms")


def with_word_tables(terms: DataFrame, canonical: DataFrame, stops: DataFrame, spread_by: str) -> DataFrame:
    """The second half of an analyser that takes tables: canonical forms, then without stop words.

    ``terms(field, term, ...)``, ``canonical(field, term, canonical)``, ``stops(field, term)``; fields
    without entries stay as they are. Rows are not merged; a NULL term stays.
    """
    named = lookup_join(terms, canonical, ["field", "term"], "left", spread_by=spread_by)
    named = named.withColumn("term", F.coalesce("canonical", "term")).drop("canonical")
    return lookup_join(named, stops, ["field", "term"], "left_anti", spread_by=spread_by)


def retabled(forward: DataFrame, canonical: DataFrame, stops: DataFrame) -> DataFrame:
    """Forward rows after :func:`with_word_tables`: terms of equal form are one, and lengths follow.

    The rows keep their buckets, so nothing is shuffled while the tables can be broadcast.
    """
    keys = ["field", "doc_id", "doc_no"]
    # The NULL term keeps documents that have no term left.
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(0).alias("tf")))
    terms = forward.select(*keys, F.inline(F.concat("terms", nothing)))
    counted = with_word_tables(terms, canonical, stops, "doc_id").groupBy(*keys, "term").agg(F.sum("tf").cast("int").alias("tf"))
    held = counted.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("term", "tf"))).alias("terms"), F.sum("tf").cast("int").alias("doc_len"))
    return held.select(*keys, "doc_len", F.filter("terms", lambda t: t["term"].isNotNull()).alias("terms"))


def opened(forward: DataFrame, *keep: str) -> DataFrame:
    """Postings ``(field, doc_id, *keep, term, tf, doc_len)`` of forward rows."""
    rows = open_terms(forward, ["field", "doc_id", *keep, "doc_len"])
    return rows.select("field", "doc_id", *keep, "term", "tf", "doc_len")


def build_index(docs: DataFrame, fields: list[str] | dict[str, str]) -> Index:
    """Postings and field statistics of the named text fields.

    All tables are lazy; :func:`write_index` stores them, which pays off from the second search on.
    """
    forward = forward_rows(docs, fields)
    postings = opened(forward)
    lengths = analyzed_fields(docs, fields).select("field", F.size("tokens").alias("doc_len"))
    return Index(postings, field_statistics(lengths), term_statistics(postings))


def field_statistics(lengths: DataFrame) -> DataFrame:
    """Documents that have the field, and their mean length."""
    return (
        lengths.where(F.col("doc_len") > 0)
        .groupBy("field")
        .agg(F.count("*").alias("n_docs"), F.avg("doc_len").alias("avg_len"))
    )


def term_statistics(postings: DataFrame) -> DataFrame:
    """Document frequency of every term: ``(field, term, df)``."""
    return postings.groupBy("field", "term").agg(F.count("*").alias("df"))


def saturation(tf: str, doc_len: str, average: Column | str, k1: float = K1, b: float = B) -> Column:
    """What one query word of weight 1 adds: grows with ``tf``, falls with ``doc_len``."""
    average = F.col(average) if isinstance(average, str) else average
    return F.col(tf) * (k1 + 1) / (F.col(tf) + k1 * (1 - b + b * F.col(doc_len) / average))


def chunked(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[tuple]:
    """Forward rows in chunks of one field, and their postings: ``(field, rows, of, terms, codes, places)``.

    ``terms`` are the chunk's terms in order; a posting has the row ``of`` the chunk, the term ``codes``
    and its place in the opened ``terms`` column.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            for name in pc.unique(part["field"]):
                own = part.filter(pc.equal(part["field"], name))
                sizes = pc.fill_null(pc.list_value_length(own["terms"]), 0).to_numpy(False)
                held = pc.struct_field(own["terms"].flatten(), "term").dictionary_encode()
                codes = pc.fill_null(held.indices, -1).to_numpy(False)
                places = np.flatnonzero(codes >= 0)
                if not len(places):
                    continue
                order = pc.sort_indices(held.dictionary).to_numpy()
                rank = np.empty(len(order), np.int32)
                rank[order] = np.arange(len(order), dtype=np.int32)
                of = np.repeat(np.arange(own.num_rows, dtype=np.int32), sizes)
                yield name, own, of[places], held.dictionary.take(pa.array(order)), rank[codes[places]], places


def impacts(tf: np.ndarray, doc_len: np.ndarray, average: float) -> np.ndarray:
    """:func:`saturation` under the usual parameters."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * doc_len / average))


def bounded_statistics(blocks: DataFrame) -> DataFrame:
    """As :func:`term_statistics`, from blocks, with the bounds of each term's ``impact``, ``tf`` and length."""
    counted = blocks.groupBy("field", "part", "term").agg(
        F.sum("n").alias("df"), F.max("impact").alias("impact"), F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len")
    )
    return counted.select("field", "term", "df", "impact", "max_tf", "min_len", "part")


def packed(columns: list[np.ndarray | bytes]) -> bytes:
    """Arrays of integers, and bytes, as compressed bytes.

    The first bytes of an array's values are compressed together, then their second ones, and so on: the
    values are small, so the upper bytes take next to nothing.
    """
    planes = [memoryview(c) if isinstance(c, bytes) else np.ascontiguousarray(c.view(np.uint8).reshape(-1, c.itemsize).T) for c in columns]
    frames = [pa.compress(pa.py_buffer(p), PACKED_BY, asbytes=True) if p.nbytes else b"" for p in planes]
    sizes = np.array([(p.nbytes, len(f)) for p, f in zip(planes, frames)], np.int64)
    return b"".join([sizes.tobytes(), *frames])


def unpacked(data: bytes, kinds: list[type]) -> list[np.ndarray | bytes]:
    """The columns of :func:`packed`; ``kinds`` are numpy's types, and ``bytes``."""
    sizes = np.frombuffer(data, np.int64, 2 * len(kinds)).reshape(-1, 2)
    ends = sizes.nbytes + np.cumsum(sizes[:, 1])
    columns = []
    for kind, (size, held), end in zip(kinds, sizes.tolist(), ends.tolist()):
        raw = pa.decompress(data[end - held : end], size, PACKED_BY, asbytes=True) if size else b""
        if kind is not bytes:
            width = np.dtype(kind).itemsize
            raw = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()
        columns.append(raw)
    return columns


# The columns of a pack: lengths of its terms, in order, and their UTF-8; postings of each term; of each posting
# the place of its document, as the step from the one before, and its tf; the documents' numbers, as steps, and
# lengths, and their ids: steps, or a batch of Arrow if they are no integers or some are NULL.
PACKED_BY = "zstd"
PACK = [np.int32, bytes, np.int32, np.int32, np.int32, np.int64, np.int32, np.int64, bytes]


def steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def packed_postings(terms: pa.Array, n: np.ndarray, doc: np.ndarray, tf: np.ndarray, doc_no: np.ndarray, doc_len: np.ndarray, doc_id: pa.Array) -> bytes:
    whole = pa.types.is_integer(doc_id.type) and not doc_id.null_count
    ids = steps(doc_id.cast(pa.int64()).to_numpy()) if whole else np.zeros(0, np.int64)
    batch = b"" if whole else pa.RecordBatch.from_arrays([doc_id], ["doc_id"]).serialize().to_pybytes()
    lengths = pc.binary_length(terms).to_numpy().astype(np.int32)
    text = pc.binary_join(pa.array([terms.to_pylist()], pa.list_(pa.string())), "")[0].as_buffer().to_pybytes()
    numbers = [n.astype(np.int32), steps(doc.astype(np.int32)), tf.astype(np.int32), steps(doc_no), doc_len.astype(np.int32)]
    return packed([lengths, text, *numbers, ids, batch])


def unpacked_postings(data: bytes, kind: pa.DataType) -> tuple:
    """The arguments of :func:`packed_postings`."""
    lengths, text, n, doc, tf, doc_no, doc_len, ids, batch = unpacked(data, PACK)
    offsets = np.cumsum(lengths, dtype=np.int32)
    terms = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(np.append(np.int32(0), offsets)), pa.py_buffer(text))
    if batch:
        doc_id = pa.ipc.read_record_batch(pa.py_buffer(batch), pa.schema([("doc_id", kind)])).column(0)
    else:
        doc_id = pa.array(np.cumsum(ids)).cast(kind)
    return terms, n, np.cumsum(doc, dtype=np.int32), tf, np.cumsum(doc_no), doc_len, doc_id


def term_packs(forward: DataFrame, n_docs: int, limit: int, parts: int) -> DataFrame:
    """Forward rows turned by term: ``(field, part, piece, postings)``, the postings of a chunk for one folder, packed.

    Terms and documents are written once for many postings before these are shuffled. A term's postings are
    dealt by document to as many pieces as it would need if all ``n_docs`` had it as often as the chunk's: what
    the chunks give to a piece adds up to about ``limit`` at most.
    """
    step, kind = CHUNK_DOCUMENTS, to_arrow_type(forward.schema["doc_id"].dataType)

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for field, own, of, terms, codes, places in chunked(batches, step):
            folder = np.empty(len(terms), np.int32)
            folder[codes] = own["parts"].flatten().to_numpy(False)[places]
            by_folder = np.empty(len(terms), np.int32)
            by_folder[np.argsort(folder, kind="stable")] = np.arange(len(terms), dtype=np.int32)
            order = np.argsort(by_folder[codes], kind="stable")
            code, of = codes[order], of[order]
            tf = pc.struct_field(own["terms"].flatten(), "tf").to_numpy(False)[places[order]]
            part, piece = folder[code], np.zeros(len(order), np.int32)
            many = -(-np.bincount(codes, minlength=len(terms)) * n_docs // (limit * np.count_nonzero(np.bincount(of))))
            if many.max() > 1:
                piece = (own["hash"].to_numpy()[of] % many[code]).astype(np.int32)
                order = np.lexsort((piece, part))
                code, of, tf, part, piece = (v[order] for v in (code, of, tf, part, piece))
            firsts = np.flatnonzero((np.diff(part, prepend=-1) != 0) | (np.diff(piece, prepend=-1) != 0))
            doc_id, doc_no, doc_len = own["doc_id"].cast(kind), own["doc_no"].to_numpy(), own["doc_len"].to_numpy(False)
            place = np.zeros(own.num_rows, np.int32)
            made = []
            for start, end in zip(firsts, np.append(firsts[1:], len(order))):
                docs = np.unique(of[start:end])
                place[docs] = np.arange(len(docs))
                runs = np.flatnonzero(np.diff(code[start:end], prepend=-1))
                named, n = terms.take(pa.array(code[start:end][runs])), np.diff(runs, append=end - start)
                made.append(packed_postings(named, n, place[of[start:end]], tf[start:end], doc_no[docs], doc_len[docs], doc_id.take(pa.array(docs))))
            columns = [pa.array(part[firsts], pa.int32()), pa.array(piece[firsts], pa.int32()), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.repeat(field, len(firsts)), *columns], ["field", "part", "piece", "postings"])

    folders = F.transform("terms", lambda t: folder_of(t["term"], parts)).alias("parts")
    # Not negative, as a hash modulo pieces.
    spread = F.xxhash64("doc_id").bitwiseAND((1 << 62) - 1).alias("hash")
    rows = forward.select("field", "doc_id", "doc_no", "doc_len", "terms", folders, spread)
    return rows.mapInArrow(turned, "field string, part int, piece int, postings binary")


def blocks_of_packs(rows: Iterator[pa.RecordBatch], averages: dict[str, float], size: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The blocks of packs sorted by folder and piece; those of one may lie in several batches."""

    def made(field: str, part: int, piece: int, packs: list[bytes]) -> pa.RecordBatch:
        names, counts, docs, tfs, numbers, lengths, ids = zip(*(unpacked_postings(p, kind) for p in packs))
        terms = pa.concat_arrays(names).dictionary_encode()
        by_term = pc.sort_indices(terms.dictionary).to_numpy()
        rank = np.empty(len(by_term), np.int32)
        rank[by_term] = np.arange(len(by_term), dtype=np.int32)
        group = np.repeat(rank[terms.indices.to_numpy()], np.concatenate(counts))
        before = np.cumsum([0, *(len(x) for x in lengths[:-1])], dtype=np.int32)
        doc, tf = np.concatenate([at + d for at, d in zip(before, docs)]), np.concatenate(tfs)
        doc_id, doc_no, doc_len = pa.concat_arrays(ids), np.concatenate(numbers), np.concatenate(lengths)
        plain = pa.types.is_integer(doc_id.type) and not doc_id.null_count
        ids = doc_id if plain else pc.rank(doc_id, "ascending", null_placement="at_start", tiebreaker="dense")
        impact = impacts(tf, doc_len[doc], averages[field])
        order = np.lexsort((ids.to_numpy()[doc], -impact, group))
        doc, tf, impact, group = doc[order], tf[order], impact[order], group[order]
        sizes = np.bincount(group)
        place = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        starts = np.flatnonzero(place % size == 0)
        values = [doc_id.take(pa.array(doc)), pa.array(doc_no[doc]), pa.array(tf), pa.array(doc_len[doc])]
        entries = pa.StructArray.from_arrays(values, POSTING)
        columns = {
            "field": pa.repeat(field, len(starts)),
            "part": pa.repeat(pa.scalar(part, pa.int32()), len(starts)),
            "piece": pa.repeat(pa.scalar(piece, pa.int32()), len(starts)),
            "term": terms.dictionary.take(pa.array(by_term[group[starts]])),
            "block": pa.array((place[starts] // size).astype(np.int32)),
            "n": pa.array(np.diff(starts, append=len(order))),
            "impact": pa.array(impact[starts]),
            "max_tf": pa.array(np.maximum.reduceat(tf, starts)),
            "min_len": pa.array(np.minimum.reduceat(doc_len[doc], starts)),
            "entries": pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)).astype(np.int32)), entries),
        }
        return pa.RecordBatch.from_pydict(columns)

    key, held = None, []
    for batch in rows:
        for *own, pack in zip(*(batch[c].to_pylist() for c in ("field", "part", "piece", "postings"))):
            if held and own != key:
                yield made(*key, held)
                held = []
            key = own
            held.append(pack)
    if held:
        yield made(*key, held)


def term_blocks(forward: DataFrame, field: str, average: float, n_docs: int, limit: int, parts: int) -> DataFrame:
    """The postings of one field by term, in blocks: see :class:`Index`.

    The chunks' postings are dealt to folders, and those of a frequent term to pieces, before they are
    shuffled, so no task holds all of its postings. One shuffle of packs serves the order, the blocks and the files.
    """
    packs = term_packs(forward.where(F.col("field") == field), n_docs, limit, parts)
    task = F.pmod(F.col("part") + F.col("piece"), F.lit(parts)).cast("int")
    ordered = packs.repartitionById(parts, task).sortWithinPartitions("part", "piece")
    size, kind = BLOCK_POSTINGS, forward.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)

    def blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return blocks_of_packs(rows, {field: average}, size, arrow)

    return ordered.mapInArrow(
        blocks,
        "field string, part int, piece int, term string, block int, n long, impact double, max_tf int, min_len int, "
        f"entries array<struct<doc_id: {kind.simpleString()}, doc_no: long, tf: int, doc_len: int>>",
    )


def folder_of(term: str, parts: int) -> Column:
    """``part``: the folder of a term."""
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int").alias("part")


def with_ordinal(scan: DataFrame) -> DataFrame:
    """Add the position of each row of a file scan, from 0, as ``ordinal``: files by path, then rows.

    A split of a file is read in order by one task, which may read other splits before it. So a
    row's place inside its split is its place in the task less the split's smallest one, and the
    splits' offsets come from their row counts by file and position: one row per split. Nothing is
    sorted and no row leaves its task.
    """
    split = ["_file", "_start"]
    numbered = scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.expr("monotonically_increasing_id() & ((1L << 33) - 1)").alias("_place"),
    )
    counts = numbered.groupBy(*split).agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *split, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset")
    )
    return numbered.join(F.broadcast(offsets), split).select(
        *scan.columns, (F.col("_offset") + F.col("_place")).alias("ordinal")
    )


def term_bitmaps(blocks: DataFrame, term_stats: DataFrame) -> DataFrame:
    """Numbers of the documents of each frequent term, from the stored blocks: see :class:`Index`.

    Combined in the tasks; the table of frequent terms is bounded and broadcast.
    """
    frequent = F.broadcast(term_stats.where("frequent").select("field", "term"))
    return (
        blocks.select("field", "part", "term", F.col("entries.doc_no").alias("numbers"))
        .join(frequent, ["field", "term"])
        .select("field", "part", "term", F.explode("numbers").alias("doc_no"))
        .select("field", "part", "term", *bit_of_document())
        .groupBy("field", "part", "term", "bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def bit_of_document() -> list[Column]:
    """``bucket`` and ``bit`` of a document's number; numbers are dense within a bucket of documents."""
    number = F.col("doc_no") + 1
    return [F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit")]


def numbered_documents(docs: DataFrame, buckets: int) -> DataFrame:
    """The documents in their buckets, with ``doc_no``: their place there, after as many numbers as the largest
    bucket has for each bucket before. So numbers are short, and near to each other in bitmaps."""
    dealt = docs.repartition(buckets, "doc_id")
    counts = dealt.groupBy(F.spark_partition_id().alias("bucket")).agg(F.count("*").alias("n"))
    largest = counts.agg(F.max("n")).first()[0] or 1
    place = F.monotonically_increasing_id()
    number = F.shiftright(place, 33) * largest + place.bitwiseAND((1 << 33) - 1)
    return dealt.withColumn("doc_no", number)


def write_index(
    docs: DataFrame,
    fields: list[str] | dict[str, str],
    name: str,
    path: str,
    buckets: int,
    parts: int | None = None,
    canonical: DataFrame | None = None,
    stops: DataFrame | None = None,
) -> None:
    """Create or replace the stored index ``name`` of ``docs`` under ``path``.

    ``fields`` are columns of ``docs``, or map a field to the column that it analyses; all columns are
    stored. The documents are moved to their buckets once, and analysed there: documents and forward
    rows are bucketed and sorted by ``doc_id``, so that they meet each other, and hits moved to their
    buckets, without a shuffle. Term statistics come from the blocks. The postings by term take
    one shuffle for each field, one after the other, whose files go with it; ``parts`` (as many as ``buckets`` unless given) is the number of folders of a field,
    of which a search reads those of its terms. Choose ``buckets`` so that a bucket stays within a few
    hundred megabytes. ``canonical(field, term, canonical)`` and ``stops(field, term)`` are the word tables
    of fields whose analyser takes some; they are stored with the index, and searches apply them too.

    Every index has folders of its own; tables of the old index are dropped when the new files are
    complete, so a failed build leaves the old index as it was.
    """
    spark = docs.sparkSession
    path = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    fresh = f"{name}_{uuid.uuid4().hex[:8]}"

    def stored(rows: DataFrame, part: str, by: list[str], bucketed: bool, mode: str = "overwrite") -> DataFrame:
        writer = rows.write.mode(mode).options(path=f"{path}/{part}", **STORED)
        writer = writer.partitionBy(*by) if by else writer
        writer = writer.bucketBy(buckets, "doc_id").sortBy("doc_id") if bucketed else writer
        with shuffles_dropped(spark):
            writer.saveAsTable(f"{fresh}_{part}")
        return spark.table(f"{fresh}_{part}")

    numbered = numbered_documents(docs, buckets)
    documents = stored(numbered, "documents", [], True)
    rows = forward_rows(documents, fields, "doc_no")
    tables = {"canonical": canonical, "stops": stops}
    if canonical is not None or stops is not None:
        empty = "field string, term string, canonical string"
        tables["canonical"] = spark.createDataFrame([], empty) if canonical is None else canonical.select("field", "term", "canonical")
        tables["stops"] = (spark.createDataFrame([], empty) if stops is None else stops).select("field", "term").distinct()
        tables = {part: stored(table, part, [], False) for part, table in tables.items()}
        tabled = tables["canonical"].select("field").union(tables["stops"].select("field")).distinct()
        own = [r.field for r in tabled.collect() if r.field in sources_of(fields)]
        rows = rows.where(~F.col("field").isin(own)).select("field", "doc_id", "doc_no", "doc_len", "terms").unionByName(
            retabled(rows.where(F.col("field").isin(own)), tables["canonical"], tables["stops"])
        )
    forward = stored(rows, "forward", ["field"], True)
    field_stats = stored(field_statistics(forward), "field_stats", [], False)
    total = forward.agg(F.sum(F.size("terms"))).first()[0] or 0
    limit = max(PIECE_POSTINGS, total // MOST_CUT)
    found = [(r.field, r.avg_len, r.n_docs) for r in field_stats.orderBy("field").collect()]
    # A field at a time, so that only its postings are shuffled at once; an index without words has no blocks.
    for number, (field, average, n_docs) in enumerate(found or [("", 0.0, 0)]):
        made = term_blocks(forward, field, average, n_docs, limit, parts or buckets)
        made = made.sortWithinPartitions("field", "part", "term")
        blocks = stored(made, "blocks", ["field", "part"], False, "append" if number else "overwrite")
    sizes = F.broadcast(field_stats.select("field", "n_docs"))
    counted = bounded_statistics(blocks).join(sizes, "field")
    counted = counted.withColumn("frequent", F.col("df") * BITMAP_SHARE >= F.col("n_docs")).drop("n_docs")
    term_stats = stored(counted, "term_stats", ["field"], False)
    bitmaps = term_bitmaps(blocks, term_stats).repartition("field", "part")
    stored(bitmaps.sortWithinPartitions("field", "part", "term"), "bitmaps", ["field", "part"], False)
    for part in (*PARTS, *tables):
        spark.sql(f"DROP TABLE IF EXISTS {name}_{part}")
        if spark.catalog.tableExists(f"{fresh}_{part}"):
            spark.sql(f"ALTER TABLE {fresh}_{part} RENAME TO {name}_{part}")


def read_index(spark: SparkSession, name: str) -> Index:
    documents, forward, blocks, bitmaps, field_stats, term_stats = (spark.table(f"{name}_{part}") for part in PARTS)
    tables = (spark.table(f"{name}_{part}") if spark.catalog.tableExists(f"{name}_{part}") else None for part in ("canonical", "stops"))
    return Index(opened(forward), field_stats, term_stats, documents, forward, blocks, bitmaps, *tables)
