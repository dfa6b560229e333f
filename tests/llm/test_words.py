"""Phrase mining, the n-gram join and spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rankloom.llm import fm_index, ngram_join, phrase_mining, spelling_variants
from test_duplicates import near_by_force, near_texts

CAPITALS = re.compile("[A-Z]")


def lowered(text):
    return CAPITALS.sub(lambda m: m[0].lower(), text or "")


def phrases_by_force(rows, support, first):
    totals, counts = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, found in counts.items():
        frequent = {p: a for p, a in found.items() if a >= support}
        inside = defaultdict(int)
        for p, a in frequent.items():
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        scored = []
        for p, a in frequent.items():
            if len(p) > 1 and inside[p] < a:
                cuts = [(1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def prose(seed, n):
    rng = random.Random(seed)
    words = ["The", "of", "naïve", "x", "\x00", "🙂", "ÀB", "new", "york", "city", "\xa0", "b's"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "! ", "\x0b"]) for _ in range(n))


@pytest.fixture(scope="module")
def passages():
    rows = [(i, prose(i, 40 + i), ["en", "de", None][i % 3]) for i in range(60)]
    rows += [(7, rows[3][1], "en"), (7, rows[3][1], "en"), (None, "new york city " * 9, "en"), (90, None, "en"), (91, "", None), (92, " \t.", "fr")]
    return rows + [(93, "q w e r t y u " * 300, "und"), (94, "new york city. " * 400, "en")]


@pytest.mark.parametrize("places", [1 << 20, 50])
def test_collocations_equal_force(spark, monkeypatch, passages, places):
    monkeypatch.setattr(phrase_mining, "ROW_PLACES", places)  # phrases reach over the ends of rows
    docs = spark.createDataFrame([(i, t, g, 1, "w") for i, t, g in passages], "doc_id long, text string, lang string, n long, word string")
    found = phrase_mining.collocations(docs.repartition(4), support=4, first=30).collect()
    wanted = phrases_by_force(passages, 4, 30)
    assert sorted(map(tuple, found)) == wanted and len(wanted) > 60


def test_words_in_stretches_are_the_same(monkeypatch):
    text = prose(5, 3000)
    part = pa.RecordBatch.from_pydict(
        {"text": [text, None, "a b"], "lang": ["en"] * 3, "shard": pa.array([1, 1, 2], pa.int32()), "salt": pa.array([5, 5, 5], pa.int64())}
    )

    def made():
        counted = phrase_mining.WordCounts()
        rows = pa.Table.from_batches(list(phrase_mining.word_rows(part, counted)))
        counts = pa.Table.from_batches(list(counted.flush(last=True))).select(["lang", "w", "word", "n"]).to_pylist()
        return rows.select(["shard", "places", "own"]).to_pylist(), sorted(map(str, counts))

    whole = made()
    monkeypatch.setattr(phrase_mining, "STRETCH_BYTES", 64)
    assert made() == whole and len(whole[0]) == 2


def test_local_support_keeps_every_frequent_phrase(spark, passages, monkeypatch):
    monkeypatch.setattr(phrase_mining, "SHARDS", 40)  # most shards have fewer words than the support
    docs = spark.createDataFrame(passages, "doc_id long, text string, lang string")
    assert sorted(map(tuple, phrase_mining.collocations(docs, 4, 30).collect())) == phrases_by_force(passages, 4, 30)


def test_short_bytes_and_blocks_give_back_what_they_hold():
    values = np.array([0, 1, 127, 128, 16383, 16384, (1 << 21) - 1, 1 << 21, (1 << 62) + 5])
    data, edges = phrase_mining.short_bytes(values)
    assert (phrase_mining.from_short_bytes(data) == values).all() and list(np.diff(edges)) == [1, 1, 1, 2, 2, 3, 3, 4, 9]
    rng = np.random.default_rng(3)
    keys = np.unique(np.append(rng.integers(0, 1 << 30, 4000), [0, (1 << 30) - 1]))
    times = rng.integers(1, 300, len(keys))
    blocks = pa.RecordBatch.from_arrays(phrase_mining.in_blocks(keys, times), ["block", "gaps", "times"])
    row, low, n = phrase_mining.from_blocks(blocks.slice(3, 7))
    whole = keys >> phrase_mining.BLOCK_BITS
    mine = (whole >= 3) & (whole < 10)
    assert blocks.num_rows == 16 and (n == times[mine]).all()
    assert ((blocks["block"].to_numpy()[row + 3] << phrase_mining.BLOCK_BITS) + low == keys[mine]).all()
    assert phrase_mining.in_blocks(keys[:0], times[:0])[0].to_pylist() == []


def test_phrases_of_a_shard_move_in_few_rows(spark, passages, monkeypatch):
    docs = spark.createDataFrame(passages, "doc_id long, text string, lang string").coalesce(1)
    rows = phrase_mining.described(docs).where("places IS NOT NULL").selectExpr("xxhash64(lang, shard) AS g", "places", "own")
    every = spark.sparkContext.broadcast(bytes([255]) * (1 << (phrase_mining.FILTER_BITS - 3)))
    groups = rows.select("g").distinct().count()
    blocks = phrase_mining.phrase_blocks(rows, every, 2, 1).cache()
    assert blocks.count() <= 2 * groups and blocks.groupBy("g", "block").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("merged", [1, 1 << 20])
def test_blocks_of_phrases_are_merged(spark, passages, monkeypatch, merged):
    monkeypatch.setattr(phrase_mining, "BLOCK_PHRASES", 40)  # several blocks in a shard
    monkeypatch.setattr(phrase_mining, "MERGED_BYTES", merged)  # blocks go on from slice to slice
    monkeypatch.setattr(phrase_mining, "PHRASES_AT_ONCE", 30)
    docs = spark.createDataFrame(passages, "doc_id long, text string, lang string")
    assert sorted(map(tuple, phrase_mining.collocations(docs.repartition(4), 4, 30).collect())) == phrases_by_force(passages, 4, 30)
    rows = [(1, 0, 3, [(5, 2), (9, 1)]), (1, 0, 3, [(5, 1)]), (1, 1, 3, [(5, 2)]), (2, 1, 2, [(5, 2), (7, 1)]), (2, 1, 2, [(7, 1)])]
    blobs = [phrase_mining.in_blocks(*map(np.array, zip(*[(k << 20, n) for k, n in found]))) for *_, found in rows]
    batch = pa.RecordBatch.from_pydict(
        dict(zip(("g", "block", "local"), map(list, zip(*[r[:3] for r in rows])))) | {"gaps": [b[1][0].as_py() for b in blobs], "times": [b[2][0].as_py() for b in blobs]}
    )
    at = [x for part in phrase_mining.frequent_places(iter([batch.slice(0, 2), batch.slice(2)]), 1) for x in part["at"].to_pylist()]
    assert sorted(at) == sorted([5 << 18, (64 + 5) << 18, (64 + 7) << 18])


def test_collocations_of_nothing(spark):
    assert phrase_mining.collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).isEmpty()


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 3, 90), (2, 5, 80), (3, 1, 50)])
def test_ngram_join_equals_force(spark, monkeypatch, seed, width, percent):
    monkeypatch.setattr(ngram_join, "PIECE_SETS", 16)  # large groups are cut into pieces
    monkeypatch.setattr(ngram_join, "COMMON_IN_TASK", 1)
    monkeypatch.setattr(ngram_join, "COMMON_FROM", 3)
    rows = near_texts(seed, 90)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, v string, root long")
    found = ngram_join.join(docs.repartition(3), width, percent).collect()
    assert sorted((tuple(r) for r in found), key=str) == sorted((r[:3] for r in near_by_force(rows, width, percent)), key=str)


def test_ngram_join_of_nothing(spark):
    assert ngram_join.join(spark.createDataFrame([], "doc_id long, text string")).isEmpty()


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_similar_sets_share_prefix_tokens(percent):
    """What the filters ask for holds for all pairs of the wanted similarity, under any order."""
    rng = random.Random(percent)
    checked = 0
    for _ in range(3000):
        n = rng.randrange(1, 60)
        x = set(rng.sample(range(200), n))
        y = set(rng.sample(sorted(x), max(1, n - rng.randrange(max(1, n // 3))))) | set(rng.sample(range(200, 400), rng.randrange(max(1, n // 3))))
        if 100 * len(x & y) < percent * len(x | y):
            continue
        checked += 1
        order = rng.sample(range(400), 400)
        sizes = np.array([len(x), len(y)])
        held = ngram_join.held_length(sizes, percent)
        a, b = (set(sorted(s, key=order.__getitem__)[:m]) for s, m in zip((x, y), held))
        plain = ngram_join.prefix_length(sizes, percent)
        c, d = (set(sorted(s, key=order.__getitem__)[:m]) for s, m in zip((x, y), plain))
        pair = min(held - sizes) + ngram_join.overlap(sizes[0], sizes[1], percent)
        assert c & d and len(a & b) >= max(pair, *ngram_join.least_shared(sizes, percent))
    assert checked > 100


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_force(rows, least=5, at_least=3, modulus=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            place = h % len(run)
            counts[run[:place] + run[place + 1 :] if h % modulus == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= at_least}
    forms, out = {}, []
    for w, n in words.items():
        found = sorted((-words[o], o) for o in words if near(w, o))
        if found and -found[0][0] >= 2 * n:
            forms[w] = found[0][1]
        out.append((w, n, len(found)))
    def root(w):
        return root(forms[w]) if w in forms else w
    return sorted((w, forms.get(w), root(w), n, m, words[forms[w]] if w in forms else None) for w, n, m in out)


@pytest.fixture(scope="module")
def spelled():
    rng = random.Random(4)
    bases = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(5, 9))) for _ in range(60)]

    def word():
        w = list(rng.choice(bases))
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = rng.choice(["", "f", "Ü", "xy", "É", "a"])
        return "".join(w)

    texts = [(i, " ".join(word() for _ in range(120))) for i in range(50)]
    odd = [(None, "abcde " * 5), (60, None), (61, ""), (62, "Ab1cdefg_hijkl×mnopq÷ß"), (63, "ÀÁÂÃÄ " * 4), (64, "z" * 20000), (64, "z" * 20000), (65, "z" * 20000 + " " + "y" * 50 + "é")]
    return texts + odd + [(1, texts[1][1])] * 2


@pytest.mark.parametrize("block_words", [50_000, 25])
def test_variants_equal_force(spark, monkeypatch, spelled, block_words):
    monkeypatch.setattr(spelling_variants, "BLOCK_WORDS", block_words)  # frequent beginnings are cut
    docs = spark.createDataFrame([(i, t, "w", 3) for i, t in spelled], "doc_id long, text string, word string, n long")
    found = spelling_variants.variants(docs.repartition(5), modulus=7).collect()
    wanted = variants_by_force(spelled, modulus=7)
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    assert len({r[1] for r in wanted}) > 20 and any(r[1] != r[2] for r in wanted if r[1])


def test_variants_in_stretches(monkeypatch, spelled):
    texts = pa.array([t for _, t in spelled], pa.large_string()).fill_null("")
    data, offsets = np.frombuffer(texts.buffers()[2], np.uint8), np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]

    def made():
        counts = Counter()
        for batch in spelling_variants.runs(data[: offsets[-1]], offsets, [str(i) for i, _ in spelled], 5, 7):
            counts.update(dict(zip(batch.column("word").to_pylist(), batch.column("n").to_pylist())))
        return counts

    whole = made()
    monkeypatch.setattr(spelling_variants, "STRETCH_BYTES", 100)
    assert made() == whole and len(whole) > 100


def test_variants_of_nothing(spark):
    assert spelling_variants.variants(spark.createDataFrame([], "doc_id long, text string")).isEmpty()


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnopé\U0001f642"])
def test_one_error_equals_force(monkeypatch, alphabet):
    monkeypatch.setattr(fm_index, "QUERIES_AT_ONCE", 100)
    rng = random.Random(len(alphabet))
    words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(4, 9))) for _ in range(400)})
    rng.shuffle(words)
    found = set()
    for backwards in (True, False):
        queries = fm_index.Words(words, backwards)
        half = queries.lengths // 2
        pairs = fm_index.one_error(fm_index.SuffixRanks(queries), queries, half if backwards else queries.lengths - half)
        found |= {(words[i], words[j]) for i, j in zip(*pairs)}
    assert found == {(a, b) for a in words for b in words if near(a, b)} and found


def test_sets_alone_in_many_groups_keep_their_link(spark):
    """A set shares more tokens with two others, of groups of two, than with the one that it is similar to."""
    tokens = {10: list(range(100, 140)), 1: [100, 101, *range(200, 238)], 2: [102, 103, *range(300, 338)], 3: list(range(104, 140))}
    rows = []
    for v, held in tokens.items():
        n = np.array([len(held)])
        prefix = held[: int(ngram_join.held_length(n, 90)[0])]
        rows.append((v, len(held), 1, int(ngram_join.prefix_length(n, 90)[0]), prefix, prefix, prefix, np.array(held, np.uint64).tobytes()))
    schema = "v long, n long, need long, size long, first array<long>, second array<long>, third array<long>, set binary"
    found = ngram_join.similar_sets(spark.createDataFrame(rows, schema), 90)
    assert {tuple(r) for r in found.collect()} == {(3, 10)}


@pytest.mark.parametrize("percent", [50, 90])
def test_bit_maps_bound_what_sets_share(percent):
    rng = np.random.default_rng(percent)
    pool = rng.integers(1, 1 << 63, 400, np.uint64)
    sets = [np.unique(rng.choice(pool, n, False)) for n in (1, 3, 15, 16, 17, 60, 64, 65, 120, 300, 390)]
    sets += [np.append(s[: max(1, len(s) - 4)], rng.integers(1, 1 << 63, k, np.uint64)) for s in sets for k in (0, 1, 5)]
    sizes = np.array([len(s) for s in sets])
    maps = [np.frombuffer(ngram_join.bit_map(s), np.uint8) for s in sets]
    i, j, most = ngram_join.near_pairs(maps, sizes, np.ones((len(sets), len(sets)), bool), percent)
    found = {(min(a, b), max(a, b)): m for a, b, m in zip(i.tolist(), j.tolist(), most.tolist())}
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            common = len(np.intersect1d(sets[a], sets[b]))
            bound = ngram_join.most_shared(maps[a], maps[b], sizes[a], sizes[b])
            assert common <= bound <= min(sizes[a], sizes[b])
            assert found.get((a, b), bound) == bound
            if 100 * common >= percent * (sizes[a] + sizes[b] - common):
                assert (a, b) in found
    assert len(found) < len(sets) * (len(sets) - 1) // 2


def test_pairs_are_dropped_before_their_sets_move(spark):
    """Pairs that share prefix tokens only are told by their bit maps; a similar pair stays."""
    rng = np.random.default_rng(7)
    sets = {v: np.unique(rng.integers(1, 1 << 63, 200, np.uint64)) for v in range(4)}
    sets[4] = np.unique(np.append(sets[0][:195], rng.integers(1, 1 << 63, 5, np.uint64)))
    rows = spark.createDataFrame([(v, len(s), s.tobytes()) for v, s in sets.items()], "v long, n long, set binary")
    pairs = spark.createDataFrame([(a, b) for a in range(5) for b in range(a + 1, 5)], "a long, b long")
    found = ngram_join.likely(pairs, ngram_join.sketched(rows), 90).collect()
    assert [(r.a, r.b) for r in found] == [(0, 4)] and 195 <= found[0].shared <= 200
    assert [tuple(r) for r in ngram_join.verified(pairs, rows, 90).collect()] == [(0, 4)]
