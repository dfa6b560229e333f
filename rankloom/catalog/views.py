"""The inputs of :mod:`rankloom.catalog.inputs` as SQL views, for the SQL side of each query.

Where a rounded value may be a tiny negative number, ``+ 0.0`` turns SQL's negative zero into zero.
"""

from __future__ import annotations

import re

WORD = r"[\p{L}\p{N}]+(?:''[\p{L}\p{N}]+)*"
CLASSIC = (
    r"[\p{L}\p{N}]+(?:[._-][\p{L}\p{N}]+)*@[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)+"
    r"|[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)+|" + WORD
)
LOOSE = r"""[^\s'',:;@#$%&?!()\[\]{}<>"]+"""


def tok(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{WORD}')"


def cased(text: str) -> str:
    return f"regexp_extract_all({text}, '{WORD}')"


def folded(text: str) -> str:
    plain = f"strip_accents({text})"
    for letter, spelled in {
        "ø": "o", "ł": "l", "đ": "d", "ð": "d", "ı": "i", "ħ": "h",
        "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th",
    }.items():
        plain = f"replace({plain}, '{letter}', '{spelled}')"
    return plain


def white(text: str) -> str:
    return f"list_filter(regexp_split_to_array({folded(f'lower({text})')}, '\\s+'), lambda t: t <> '')"


def classic(text: str) -> str:
    return f"regexp_extract_all({folded(f'lower({text})')}, '{CLASSIC}')"


def norm_terms(text: str) -> str:
    """Normalised tokens of a text, one-letter ones dropped."""
    return (
        f"list_filter(list_transform(regexp_extract_all(lower({text}), '{LOOSE}'), "
        "lambda t: regexp_replace(t, '[^a-zA-Z0-9-]', '', 'g')), lambda t: length(t) > 1)"
    )


VIEWS: dict[str, str] = {
    "corpus": """
        SELECT d.doc_id, split_part(d.text, chr(10), 1) AS title, d.source AS author,
               d.text AS content,
               strftime(DATE '2018-01-01' + CAST(d.doc_id % 365 AS INTEGER), '%Y/%m/%d') AS published_date,
               CASE WHEN l.doc_id IS NULL THEN ''
                    WHEN d.doc_id % 97 = 0 THEN CAST(d.doc_id % n.n AS VARCHAR)
                    ELSE concat(CAST(d.doc_id % n.n AS VARCHAR), '-',
                         CASE WHEN l.quality = 1 AND l.toxic = 0 THEN '2'
                              WHEN l.quality = 1 THEN '1' ELSE '0' END) END AS annotation
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id,
             (SELECT count(*) AS n FROM benchmark) n""",
    "annotated": """
        SELECT doc_id, annotation, split_part(annotation, '-', 1) AS topic_id,
               CAST(split_part(annotation, '-', 2) AS INTEGER) AS grade
        FROM corpus WHERE contains(annotation, '-')""",
    "topics": """
        SELECT CAST(item_id AS VARCHAR) AS topic_id,
               trim(replace(split_part(text, '.', 1), chr(10), ' ')) AS title,
               trim(split_part(text, chr(10), 1)) AS description,
               trim(replace(text, chr(10), ' ')) AS narrative
        FROM benchmark""",
    "queries": """
        SELECT concat(topic_id, '-title') AS query_id, topic_id, 'title' AS query_type, title AS query_text FROM topics
        UNION ALL SELECT concat(topic_id, '-description'), topic_id, 'description', description FROM topics
        UNION ALL SELECT concat(topic_id, '-narrative'), topic_id, 'narrative', narrative FROM topics""",
    "bench_terms": f"""
        SELECT term, count(*) AS n_items
        FROM (SELECT item_id, unnest(list_distinct({tok('text')})) AS term FROM benchmark) GROUP BY term""",
    "stopwords": """
        SELECT term FROM bench_terms WHERE n_items * 4 >= (SELECT count(*) FROM benchmark)""",
    "word_vectors": """
        SELECT t.term, CAST(e.embedding AS DOUBLE[]) AS vec, e.vec_id
        FROM bench_terms t JOIN embeddings e ON e.vec_id =
            CAST(concat('0x', substring(md5(t.term), 1, 8)) AS BIGINT) % (SELECT count(*) FROM embeddings)""",
    "query_vectors": """
        SELECT q.query_id, CAST(e.embedding AS DOUBLE[]) AS vec
        FROM queries q JOIN embeddings e
          ON e.vec_id = CAST(q.topic_id AS BIGINT) % (SELECT count(*) FROM embeddings)""",
    "chunks": """
        SELECT doc_id, chunk_no, substring(content, CAST(chunk_no * 1024 + 1 AS INTEGER), 1024) AS chunk
        FROM (SELECT doc_id, content, CAST(unnest(generate_series(0, length(content) // 1024)) AS INTEGER) AS chunk_no
              FROM corpus)""",
    "chunk_vectors": """
        SELECT c.doc_id, c.chunk_no, CAST(e.embedding AS DOUBLE[]) AS vec
        FROM chunks c JOIN embeddings e
          ON e.vec_id = (c.doc_id * 31 + c.chunk_no) % (SELECT count(*) FROM embeddings)""",
    "doc_vectors": """
        SELECT doc_id, list(v ORDER BY dim) AS vec FROM (
          SELECT doc_id, dim, avg(v) AS v
          FROM (SELECT doc_id, unnest(vec) AS v, unnest(generate_series(1, len(vec))) AS dim FROM chunk_vectors)
          GROUP BY doc_id, dim) GROUP BY doc_id""",
    "senses": """
        SELECT term, 1 AS sense_rank, vec_id AS sense_id FROM word_vectors
        UNION ALL SELECT term, 2, (vec_id + 3) % (SELECT count(*) FROM embeddings) FROM word_vectors""",
    "lemmas": """
        SELECT vec_id AS sense_id,
               CAST(row_number() OVER (PARTITION BY vec_id ORDER BY term) AS INTEGER) AS lemma_no,
               CASE WHEN length(term) % 3 = 0 THEN concat(term, '_', reverse(term)) ELSE term END AS lemma
        FROM word_vectors""",
    "definitions": """
        SELECT (vec_id + (SELECT count(*) FROM embeddings) - 1) % (SELECT count(*) FROM embeddings) AS sense_id,
               string_agg(term, ' ' ORDER BY term) AS definition
        FROM word_vectors GROUP BY vec_id""",
    "lexicon": """
        SELECT term, CASE length(term) % 3 WHEN 0 THEN 'NOUN' WHEN 1 THEN 'ADJ' ELSE 'OTHER' END AS tag
        FROM bench_terms""",
    "instance_of": """
        SELECT concat('Q1', c_custkey) AS entity, concat('Q3', c_nationkey) AS class FROM customer
        UNION ALL SELECT concat('Q2', s_suppkey), concat('Q3', s_nationkey) FROM supplier""",
    "subclass_of": """
        SELECT concat('Q3', n_nationkey) AS class, concat('Q4', n_regionkey) AS parent FROM nation""",
    "kg_classes": """
        SELECT concat('Q3', n_nationkey) AS entity, 'nation' AS kind, regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') AS name FROM nation
        UNION ALL SELECT concat('Q4', r_regionkey), 'region', regexp_replace(lower(r_name), '[^a-z0-9]', '', 'g') FROM region""",
    "graph_labels": """
        SELECT concat('Q1', c_custkey) AS entity,
               CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END AS label, c_mktsegment AS description
        FROM customer
        UNION ALL SELECT concat('Q2', s_suppkey), s_name, NULL FROM supplier
        UNION ALL SELECT entity, concat(kind, ' ', name), NULL FROM kg_classes""",
    "graph_queries": """
        SELECT entity AS query_id, concat('suppliers from ', kind, ' ', name) AS query_text FROM kg_classes""",
    "graph_lexicon": """
        SELECT name AS term, 'NOUN' AS tag FROM kg_classes
        UNION SELECT kind, 'NOUN' FROM kg_classes
        UNION SELECT 'suppliers', 'NOUN' UNION SELECT 'from', 'OTHER'""",
    "closure": """
        SELECT l.label AS phrase, l.entity AS class FROM graph_labels l JOIN kg_classes k ON l.entity = k.entity
        UNION SELECT c.phrase, s.class FROM closure c JOIN subclass_of s ON s.parent = c.class""",
    "entities": """
        SELECT m.phrase, m.place, m.entity, coalesce(l.label, m.entity) AS label, l.description
        FROM (SELECT phrase, entity,
                     CAST(row_number() OVER (PARTITION BY phrase ORDER BY entity) AS INTEGER) AS place
              FROM (SELECT DISTINCT c.phrase, i.entity FROM closure c JOIN instance_of i ON i.class = c.class)) m
        LEFT JOIN graph_labels l ON l.entity = m.entity WHERE m.place <= 50""",
    "anchors": f"""
        SELECT item_id, text, anchor FROM (
          SELECT item_id, text, anchor,
                 row_number() OVER (PARTITION BY item_id ORDER BY length(anchor) DESC, anchor) AS r
          FROM (SELECT item_id, text, unnest({tok('text')}) AS anchor FROM benchmark)) WHERE r = 1""",
    "qrels": f"""
        SELECT DISTINCT CAST(a.item_id AS VARCHAR) AS topic_id, d.doc_id,
               CASE WHEN contains(d.text, a.text) THEN 2 ELSE 1 END AS grade
        FROM (SELECT doc_id, text, unnest(list_distinct({tok('text')})) AS term FROM documents) d
        JOIN anchors a ON a.anchor = d.term""",
    "doc_terms": f"""
        SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf
        FROM (SELECT doc_id, unnest({tok('content')}) AS term FROM corpus) GROUP BY doc_id, term""",
    "idf": """
        SELECT term, count(*) AS df, ln((1.0 + (SELECT count(*) FROM corpus)) / (1.0 + count(*))) + 1.0 AS idf
        FROM doc_terms GROUP BY term""",
    "query_terms_tf": f"""
        SELECT query_id, term, CAST(count(*) AS INTEGER) AS tf
        FROM (SELECT query_id, unnest({tok('query_text')}) AS term FROM queries) GROUP BY query_id, term""",
}

RECURSIVE = {"closure"}


def search_views(name: str, doc_tokens: str, query_tokens: str, source: str = "corpus",
                 queries: str = "queries") -> dict[str, str]:
    """Views ``<name>_post``, ``_stat``, ``_scores`` and ``_hits`` of one BM25 search."""
    return {
        f"{name}_tokens": f"SELECT doc_id, {doc_tokens} AS tokens FROM {source}",
        f"{name}_post": f"""
            SELECT doc_id, term, count(*) AS tf, any_value(doc_len) AS doc_len
            FROM (SELECT doc_id, unnest(tokens) AS term, len(tokens) AS doc_len FROM {name}_tokens)
            GROUP BY doc_id, term""",
        f"{name}_stat": f"""
            SELECT count(*) AS n_docs, avg(len(tokens)) AS avg_len FROM {name}_tokens WHERE len(tokens) > 0""",
        f"{name}_df": f"SELECT term, count(*) AS df FROM {name}_post GROUP BY term",
        f"{name}_qt": f"""
            SELECT query_id, term, count(*) AS qtf
            FROM (SELECT query_id, unnest({query_tokens}) AS term FROM {queries}) GROUP BY query_id, term""",
        f"{name}_scores": f"""
            SELECT q.query_id, p.doc_id,
                   round(sum(q.qtf * ln(1 + (s.n_docs - f.df + 0.5) / (f.df + 0.5))
                       * (p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.doc_len / s.avg_len)))), 6) AS score
            FROM {name}_qt q JOIN {name}_df f ON f.term = q.term JOIN {name}_post p ON p.term = q.term,
                 {name}_stat s
            GROUP BY q.query_id, p.doc_id""",
        f"{name}_hits": f"SELECT query_id, doc_id, score, {rank('score')} AS rank FROM {name}_scores",
    }


def rank(score: str) -> str:
    return (
        f"CAST(row_number() OVER (PARTITION BY query_id ORDER BY {score} DESC NULLS LAST, "
        "CAST(doc_id AS VARCHAR) DESC) AS INTEGER)"
    )


VIEWS |= search_views("content", tok("content"), tok("query_text"))
VIEWS |= search_views("title", tok("title"), tok("query_text"))
VIEWS |= search_views("classic", classic("content"), classic("query_text"))
VIEWS |= search_views("custom", white("content"), white("query_text"))
VIEWS["top20"] = "SELECT * FROM content_hits WHERE rank <= 20"
VIEWS["judged"] = """
    SELECT h.query_id, h.doc_id, h.score, h.rank, coalesce(a.grade, 0) AS grade
    FROM top20 h JOIN queries q ON q.query_id = h.query_id
    LEFT JOIN annotated a ON a.doc_id = h.doc_id AND a.topic_id = q.topic_id"""


def pooled(name: str, source: str, key: str, text: str) -> dict[str, str]:
    """View ``<name>(key, dim, v)``: mean word vector, from 1; every text has all dimensions."""
    return {
        f"{name}_tokens": f"SELECT {key}, unnest({norm_terms(text)}) AS term FROM {source}",
        f"{name}_valid": f"""
            SELECT {key}, term FROM {name}_tokens WHERE term NOT IN (SELECT term FROM stopwords)""",
        f"{name}_n": f"SELECT {key}, count(*) AS n FROM {name}_valid GROUP BY {key}",
        f"{name}_sum": f"""
            SELECT t.{key}, u.dim, sum(t.tf * t.vec[u.dim]) AS v
            FROM (SELECT v.{key}, w.vec, count(*) AS tf FROM {name}_valid v JOIN word_vectors w ON w.term = v.term
                  GROUP BY v.{key}, v.term, w.vec) t,
                 (SELECT unnest(generate_series(1, 64)) AS dim) u GROUP BY t.{key}, u.dim""",
        name: f"""
            SELECT d.{key}, CAST(u.dim AS INTEGER) AS dim, coalesce(s.v / n.n, 0.0) AS v
            FROM (SELECT DISTINCT {key} FROM {source}) d
            CROSS JOIN (SELECT unnest(generate_series(1, 64)) AS dim) u
            LEFT JOIN {name}_n n ON n.{key} = d.{key}
            LEFT JOIN {name}_sum s ON s.{key} = d.{key} AND s.dim = u.dim""",
    }


VIEWS |= pooled("doc_pool", "corpus", "doc_id", "content")
VIEWS |= pooled("query_pool", "queries", "query_id", "query_text")


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """The query preceded by the views that it names, directly or through other views."""
    views = VIEWS | (extra or {})
    ordered: list[str] = []

    def visit(sql: str, own: str | None = None) -> None:
        for name in views:
            if name != own and name not in ordered and re.search(rf"\b{name}\b", sql):
                visit(views[name], name)
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    # Views that hold rows of text analysis are kept, the others may be inlined.
    recursive = "RECURSIVE " if RECURSIVE & set(ordered) else ""

    def kept(name: str) -> str:
        return "" if name in RECURSIVE else "MATERIALIZED "

    clauses = ",\n".join(f"{name} AS {kept(name)}({views[name]})" for name in ordered)
    return f"WITH {recursive}{clauses}\n{body}"
