"""Token counts, packing and token files against the tokenizer libraries themselves."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rankloom.llm import bpe_counts, packing, simple8b, word_ids

TEXTS = [
    None,
    "",
    " ",
    "  two  spaces ",
    "The theatre, again.\nIt's DON'T — really!!",
    "x<|endoftext|>y <|startoftext|> <s></s> <0x0A>",
    "a\x00b\tc\r\nd\x0be\x0cf\x85g　h\x1fi",
    "á b́ ́c J̌ ǰ İstanbul ﬁ Σας ΣΑΣ ½ ①1234 가 ᆨ 🙂 ▁▁ x▁y",
    "word." * 3000,
    "z" * 5000,
    "the same text",
    "the same text",
    *("token " * n + "end" for n in range(1, 40, 7)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"n{i}", i) for i, t in enumerate(TEXTS)] + [(None, "no id", None, None), (4, TEXTS[4], "again", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, part long").repartition(3)


def test_counts_equal_the_library(docs):
    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    rows = bpe_counts.token_counts(docs, model, limit=1000).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        n = len(library.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1000)


def test_forgetting_changes_no_count(monkeypatch):
    model = public_tokenizers.path("piece_bpe_32k.model")
    texts = [t for t in TEXTS if t]
    whole = [bpe_counts.Merger(model).count(t) for t in texts]
    monkeypatch.setattr(bpe_counts, "MEMORY_SEGMENTS", 3)
    small = bpe_counts.Merger(model)
    assert [small.count(t) for t in texts] == whole


@pytest.mark.parametrize("memory", [2, 500_000])
def test_ids_by_word_equal_the_library(monkeypatch, memory):
    monkeypatch.setattr(word_ids, "MEMORY_WORDS", memory)
    coder = word_ids.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert coder.by_word
    texts = [t or "" for t in TEXTS]
    for _ in range(2):
        ids, counts = coder.encode(pa.array(texts, pa.large_string()))
        edges = np.concatenate([[0], np.cumsum(counts)])
        for i, text in enumerate(texts):
            assert ids[edges[i] : edges[i + 1]].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_at_white_space(monkeypatch):
    file = public_tokenizers.path("word_bpe_49k.json")
    texts = ["It's a long text. " * 200, "x" * 500 + " y " + "z" * 700, "", "a\u3000b" * 90]
    rows = [pa.record_batch({"text": pa.array(texts)})]
    whole = [ids.tolist() for _, ids, _ in word_ids.encoded(iter(rows), file, 7)]
    monkeypatch.setattr(word_ids, "SLICE_BYTES", 64)
    cut = [ids.tolist() for _, ids, _ in word_ids.encoded(iter(rows), file, 7)]
    assert len(cut) > 2 and sum(cut, []) == sum(whole, [])


def test_other_tokenizers_are_run_text_by_text():
    coder = word_ids.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not coder.by_word
    ids, counts = coder.encode(pa.array(["a  b", "", "c"], pa.large_string()))
    assert ids[: counts[0]].tolist() == coder.tokenizer.encode("a  b", add_special_tokens=False).ids and counts[1] == 0


def expected_ids(text, end_id):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return coder.encode(text or "", add_special_tokens=False).ids + [end_id]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_is_gapless_and_whole(docs):
    length = 64
    rows = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2, length).collect()
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    at = 0
    for sequence, offset, size in places:
        assert sequence * length + offset == at and size > 0 and offset + size <= length
        at += size
    assert at == sum(len(expected_ids(t, 2)) for t in [*TEXTS, "no id", TEXTS[4]])
    for r in rows:
        ids = expected_ids("no id" if r.doc_id is None else TEXTS[r.doc_id], 2)
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == crc(ids[r.start : r.start + r.length])


def test_token_files_round_trip(spark, docs, tmp_path):
    simple8b.write_ids(docs, str(tmp_path / "ids"), public_tokenizers.path("word_bpe_49k.json"), 1)
    rows = simple8b.checksums(simple8b.read_ids(spark, str(tmp_path / "ids"))).orderBy("start").collect()
    wanted = sorted([(-1, "no id"), (4, TEXTS[4]), *enumerate(TEXTS)], key=lambda x: x[0])
    at = 0
    for r, (doc_id, text) in zip(rows, wanted, strict=True):
        ids = expected_ids(text, 1)
        assert (-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, at, len(ids), crc(ids))
        at += len(ids)


@pytest.mark.parametrize("n", [0, 1, 239, 1023, 1024, 1025, 7000])
@pytest.mark.parametrize("top", [1, 2, 300, 49408, 1 << 20, 1 << 32])
def test_simple8b_is_exact(monkeypatch, n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    ids[n // 3 : n // 2] = 0
    ids[n // 2 : n // 2 + 1] = (1 << 32) - 1
    coded = simple8b.encode(ids)
    assert (simple8b.decode(coded, n) == ids).all()
    monkeypatch.setattr(simple8b, "BLOCK_IDS", 2048)
    assert all((a == b).all() for a, b in zip(simple8b.encode(ids), coded, strict=True))
    if n > 1000 and top == 300:
        assert len(coded.words) * 8 < 2 * n


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    file = public_tokenizers.path("word_bpe_49k.json")
    assert packing.pack(none, file, 2).isEmpty()
    assert bpe_counts.token_counts(none, public_tokenizers.path("piece_bpe_32k.model")).isEmpty()
    simple8b.write_ids(none, str(tmp_path / "none"), file, 1)
    assert simple8b.read_ids(spark, str(tmp_path / "none")).agg(F.count("*")).first()[0] == 0


def test_token_files_of_one_hot_id_and_of_names(spark, tmp_path):
    file = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(file)
    rows = [("hot", f"the same id, text {i % 50}") for i in range(400)] + [("a", "first"), (None, "none"), ("z", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    simple8b.write_ids(docs, str(tmp_path / "names"), file, 1)
    found = simple8b.read_ids(spark, str(tmp_path / "names"), "string").orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, "a", *["hot"] * 400, "z"]
    assert [r.start for r in found] == [sum(x.n_tokens for x in found[:i]) for i in range(len(found))]
    wanted = sorted(library.encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows)
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in found) == wanted
    assert len({r.part for r in spark.read.parquet(str(tmp_path / "names")).where("array_contains(doc_ids, 'hot')").collect()}) > 1
