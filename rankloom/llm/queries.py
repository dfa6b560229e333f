"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.catalog.registry import Builder
from rankloom.llm import bpe_counts, byte_cnn, ngram_join, ngram_rules, packing, phrase_mining, secret_scan, simple8b, soft_mixing, spelling_variants, suffix_dedup, tensored_minhash, threshold_topk
from rankloom.plans import scratch

QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def query(build: Builder) -> Builder:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, domain)``: what the labels say a document is."""
    kind = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "low")
    return table(spark, sf_dir, "labels").select("doc_id", kind.alias("domain"))


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


SQL["op2_suffix_dedup"] = r"""
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents
), w AS (
  SELECT doc_id, p, substring(t, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, t, unnest(range(0, len(t) // 2 - 49)) AS p FROM h)
), m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s
), g AS (SELECT w.doc_id, w.p FROM w JOIN m ON m.s = w.s WHERE m.least < w.doc_id
), f AS (
  SELECT doc_id, p, sum(CASE WHEN p <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS span
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM g)
), spans AS (SELECT doc_id, span, min(p) AS a, max(p) + 50 AS z FROM f GROUP BY doc_id, span
), gaps AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS k, a AS e, z - a AS gone FROM spans
  UNION ALL SELECT h.doc_id, coalesce(max(s.z), 0), any_value(len(h.t) // 2), 0 FROM h LEFT JOIN spans s ON s.doc_id = h.doc_id GROUP BY h.doc_id
)
SELECT h.doc_id, CAST(any_value(len(h.t) // 2) AS BIGINT) AS n_bytes, CAST(sum(gone) AS BIGINT) AS n_removed,
       CAST(count(*) FILTER (WHERE gone > 0) AS BIGINT) AS n_spans,
       sha256(unhex(string_agg(substring(h.t, 2 * k + 1, 2 * (e - k)), '' ORDER BY k))) AS kept_sha256
FROM h JOIN gaps ON gaps.doc_id = h.doc_id GROUP BY h.doc_id
"""


@query
def op3_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "embeddings").select(
        "vec_id", threshold_topk.whole_units(F.col("embedding")).alias("units")
    )
    asked = units.where(F.col("vec_id") % 50 == 0).withColumnRenamed("vec_id", "query_id")
    return threshold_topk.top_k(asked, units, k=5)


SQL["op3_threshold_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.w) = len(q.w)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op4_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_cnn.score(docs, byte_cnn.fit(docs, table(spark, sf_dir, "labels")), keep_from=0.7)


@query
def op5_ngram_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return ngram_rules.judge(docs, ngram_rules.fit(docs, trusted))


@query
def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return soft_mixing.mix(
        table(spark, sf_dir, "documents"), domain_labels(spark, sf_dir), {"clean": 0.85, "low": 0.12, "toxic": 0.03}
    )


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tensored_minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


SQL["op8_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS t FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
    ELSE list_transform(range(1, len(t) - 1), lambda i: concat(t[i], ' ', t[i + 1], ' ', t[i + 2])) END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 85 * (a.n + b.n - i)
), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (
  SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached
), c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents d JOIN c ON c.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.fresh_path(spark, "token-ids")
    simple8b.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return simple8b.checksums(simple8b.read_ids(spark, path))


@query
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents"), support=100, first=2000)


SQL["op11_phrase_mining"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS t FROM p
), t AS (SELECT lang, sum(len(t)) AS n FROM w GROUP BY lang
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(t) - k + 2), lambda i: array_to_string(t[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS k)
), f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100
), s AS (SELECT *, string_split(phrase, ' ') AS t FROM f WHERE k > 1
), inner_ AS (
  SELECT DISTINCT lang, array_to_string(t[i:i + j - 1], ' ') AS phrase, a
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS j FROM s))
), c AS (
  SELECT s.*, unnest(range(1, k)) AS cut FROM s
  WHERE NOT EXISTS (SELECT 1 FROM inner_ o WHERE o.lang = s.lang AND o.phrase = s.phrase AND 100 * o.a >= 100 * s.a)
), x AS (
  SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, t.n, cut, CAST(1000 AS HUGEINT) * c.a * t.n // (CAST(l.a AS HUGEINT) * r.a) AS score
  FROM c JOIN t ON t.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.t[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.t[cut + 1:c.k], ' ')
), y AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM x
), z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM y WHERE place = 1)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM z WHERE rank <= 2000
"""


@query
def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), width=3, percent=90)


SQL["op12_ngram_join"] = (
    "SELECT doc_id, n_shingles, component_id FROM (" + SQL["op8_near_duplicates"].replace("100 * i >= 85 *", "100 * i >= 90 *") + ")"
)


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"))


# The check sum is linear: the sum over a message's bytes of a table's entry for the byte and the
# bytes that follow; the usual start value inverts the first four bytes.
SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE u AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), d AS (SELECT row_number() OVER () AS m, run, n, hex(encode(concat(id, ':', run))) AS h
         FROM (SELECT id, run, count(*) AS n FROM u WHERE length(run) >= 5 GROUP BY ALL)
), z AS (
  SELECT b, CAST(b AS BIGINT) AS c, 0 AS k FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT b, xor(c >> 1, 3988292384 * (c & 1)), k + 1 FROM z WHERE k < 8
), t0 AS (SELECT b, c FROM z WHERE k = 8
), tt AS (
  SELECT b, c, 0 AS after FROM t0
  UNION ALL SELECT tt.b, xor(tt.c >> 8, t0.c), after + 1 FROM tt JOIN t0 ON t0.b = tt.c & 255
  WHERE after < (SELECT max(len(h)) // 2 FROM d)
), e AS (
  SELECT m, i, len(h) // 2 - 1 - i AS after,
         16 * (strpos('0123456789ABCDEF', substring(h, 2 * i + 1, 1)) - 1) + strpos('0123456789ABCDEF', substring(h, 2 * i + 2, 1)) - 1 AS byte
  FROM (SELECT m, h, unnest(range(len(h) // 2)) AS i FROM d)
), crc AS (
  SELECT m, xor(bit_xor(tt.c), 4294967295) AS h FROM e JOIN tt ON tt.after = e.after AND tt.b = CASE WHEN i < 4 THEN 255 - byte ELSE byte END GROUP BY m
), v AS (
  SELECT CASE WHEN h % 97 = 0 THEN concat(substring(run, 1, CAST(h % length(run) AS BIGINT)), substring(run, CAST(h % length(run) AS BIGINT) + 2)) ELSE run END AS word, n
  FROM (SELECT d.run, d.n, crc.h FROM d JOIN crc ON crc.m = d.m)
), w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), x AS (SELECT word, i, concat(substring(word, 1, i - 1), substring(word, i + 1)) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)
), near AS (
  SELECT a.word, b.word AS near FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT x.word, w.word FROM x JOIN w ON w.word = x.rest
  UNION SELECT w.word, x.word FROM x JOIN w ON w.word = x.rest
), best AS (
  SELECT near.word, near.near, w.n, row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, near.near) AS place, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN w ON w.word = near.near
), f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 2 * w.n THEN near END AS form, CASE WHEN best.n >= 2 * w.n THEN best.n END AS form_n
  FROM w LEFT JOIN best ON best.word = w.word AND place = 1
), r AS (
  SELECT word, word AS at, form FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON f.word = r.form
)
SELECT f.word, f.form, r.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM f JOIN r ON r.word = f.word AND r.form IS NULL
"""
