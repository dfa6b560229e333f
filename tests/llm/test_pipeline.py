"""The pipeline's stages, each on its own input, and its registration."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from rankloom.llm import secret_scan
from test_duplicates import near_by_force

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage got and gave, as the pipeline stores them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.scratch.materialise(stage(spark, docs, SF), "test")
        found.append((name, docs, made))
        docs = made
    return found


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_the_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "secret scans", "mixing", "packing"]
    registered = __spark_entry__.queries()
    assert registered["pipeline"] is corpus_pipeline.run
    assert {f"op{n}" for n in range(1, 11)} == {name.split("_")[0] for name in registered if name.startswith("op")}


def test_columns_stay_until_the_last_stage(stages):
    for _, given, made in stages[:-1]:
        assert made.schema.simpleString() == given.schema.simpleString()


def test_clean_documents_pass_the_rules(spark, stages):
    _, given, made = stages[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = rows(made)
    good = [r for i, r in rows(given).items() if labels.get(i) == 1 and len((r.text or "").split()) >= 50]
    bad = [i for i in rows(given) if labels.get(i) == 0]
    assert np.mean([r.doc_id in kept for r in good]) > 0.99 and np.mean([i in kept for i in bad]) < 0.1
    assert all(kept[i] == r for i, r in rows(given).items() if i in kept)


def test_one_document_of_each_group_stays(stages):
    _, given, made = stages[1]
    wanted = {doc_id for doc_id, _, _, kept in near_by_force([(r.doc_id, r.text) for r in given.collect()], 5, 80) if kept}
    assert set(rows(made)) == wanted and len(wanted) < given.count()


def test_no_secret_is_left(stages):
    _, given, made = stages[2]
    before, after = rows(given), rows(made)
    assert set(before) == set(after)
    changed = [i for i in before if before[i].text != after[i].text]
    assert changed and all(not secret_scan.all_spans(r.text or "")[1] for r in after.values())
    assert all(r.n_chars == len(r.text) for r in after.values())
    assert all(bool(secret_scan.all_spans(before[i].text)[1]) == (i in changed) for i in before)


def test_mixing_keeps_clean_documents(spark, stages):
    _, given, made = stages[3]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = rows(made)
    clean = [i in kept for i in rows(given) if i in labels and labels[i].quality == 1 and labels[i].toxic == 0]
    toxic = [i in kept for i in rows(given) if i in labels and labels[i].toxic == 1]
    assert np.mean(clean) > 0.97 and np.mean(toxic) < 0.6
    assert all(kept[i] == r for i, r in rows(given).items() if i in kept)


def test_the_result_holds_every_token_once(stages):
    _, given, made = stages[4]
    coder = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    pieces = {}
    for r in made.collect():
        pieces.setdefault(r.doc_id, []).append(r)
    texts = {r.doc_id: r.text for r in given.collect()}
    assert set(texts) == set(pieces)
    for doc_id, text in texts.items():
        ids = np.array(coder.encode(text or "", add_special_tokens=False).ids + [corpus_pipeline.END_ID], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_stages_take_odd_tables(spark, tmp_path):
    for name in ("labels",):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    odd = spark.createDataFrame(
        [(1, None, "en", None, None), (None, "words " * 80, None, "s", 3), (2, "", "en", "s", 0), (3, "a b", "en", "s", 3), (3, "a b", "en", "s", 3)],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).withColumn("n_words", F.lit("clash")).withColumn("score", F.lit(1)).withColumn("_tokens", F.lit(2)).withColumn("_words", F.lit("w")).withColumn("set", F.lit("s"))
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            made = stage(spark, docs, str(tmp_path))
            assert made.columns == docs.columns and made.count() <= docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
