"""Suffix dedup and near-duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from rankloom.llm import batches, components, deep_shallow, shingles, suffix_dedup, tensored_minhash


def removed_by_force(rows):
    """Expected result of the suffix dedup, row by row."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        if doc_id is not None:
            for p in range(len(data) - 49):
                key = data[p : p + 50]
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - 49):
            if doc_id is not None and first[data[p : p + 50]] < doc_id:
                gone[p : p + 50] = [True] * 50
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeated_texts(seed):
    rng = random.Random(seed)
    words = ["the", "of", "Ünter", "and", "zq", "\x00", "\x00\x00", "aaaa", "b", "naïve", "🙂"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(50)) * rng.randrange(2) for _ in range(n))
    shared = [prose(20) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(rng.randrange(30)), *rng.sample(shared, rng.randrange(3)), prose(rng.randrange(20))]
        rows.append((i * 3, "".join(parts)))
    rows += [(500, rows[5][1]), (501, rows[5][1]), (1, rows[5][1]), (502, rows[7][1][3:90]), (503, rows[7][1] + "x")]
    rows += [(600, "a" * 300), (601, "a" * 49), (602, "a" * 50), (603, "ab" * 200), (604, "ba" * 80), (605, "\x00" * 120), (606, "x" + "\x00" * 70)]
    rows += [(700, None), (701, ""), (None, rows[5][1]), (None, None), (800, shared[0] * 3), (800, shared[0] * 3), (800, "q" + shared[1])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_dedup_equals_force(spark, seed):
    rows = repeated_texts(seed)
    docs = spark.createDataFrame([(i, t, "c", 7) for i, t in rows], "doc_id long, text string, block string, n long")
    found = suffix_dedup.remove_repeats(docs.repartition(4), block_bytes=2000).collect()
    assert sorted((tuple(r) for r in found), key=str) == removed_by_force(rows)


def test_suffix_dedup_of_long_texts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 90)  # the steps run in this process
    rows = [(i, t) for i, t in repeated_texts(3) if i is not None]
    wanted = removed_by_force(rows)
    tables = {}
    for i, t in rows:
        tables.setdefault(i % 3, []).append((i, t or ""))
    blocks = {b: pa.table({"doc_id": [i for i, _ in r], "text": [t for _, t in r]}) for b, r in tables.items()}
    key = lambda k: (pa.scalar(k),)

    def by(name, made):
        whole = pa.concat_tables(made)
        return {k: whole.filter(pc.equal(whole[name], k)) for k in set(whole[name].to_pylist())}, whole.slice(0, 0)

    hashes, _ = by("bucket", [suffix_dedup.send_hashes(5)(key(b), t) for b, t in blocks.items()])
    common, none = by("block", [suffix_dedup.find_common(key(b), t) for b, t in hashes.items()])
    sent, _ = by("bucket", [suffix_dedup.send_contexts(5)(key(b), t, common.get(b, none)) for b, t in blocks.items()])
    back, none = by("block", [suffix_dedup.smallest_holders(key(b), t) for b, t in sent.items()])
    result = pa.concat_tables([suffix_dedup.remove(5)(key(b), t, back.get(b, none)) for b, t in blocks.items()])
    assert sorted((tuple(r.values()) for r in result.to_pylist()), key=str) == wanted


def test_long_texts_have_the_same_sets(monkeypatch):
    data, edges = batches.bytes_and_offsets(pa.array([" ".join(f"Word{i % 97} \n x" for i in range(3000))], pa.large_string()))
    plain, _ = shingles.sets(data, edges, 3)
    monkeypatch.setattr(shingles, "STRETCH_BYTES", 100)
    assert (shingles.sets(data, edges, 3)[0] == plain).all() and len(plain) > 90


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).isEmpty()


@pytest.mark.parametrize("symbols", [2, 256])
def test_deep_shallow_order(symbols):
    rng = np.random.default_rng(symbols)
    rows = rng.integers(0, symbols, (500, 50)).astype(np.uint8)
    rows[100:300] = rows[rng.integers(0, 20, 200)]
    rows[200:300, 40:] = rng.integers(0, symbols, (100, 10))
    order, common = deep_shallow.sort(rows, 16)
    strings = [rows[i].tobytes() for i in order]
    assert sorted(order.tolist()) == list(range(500)) and strings == sorted(strings)
    for i in range(1, 500):
        a, b = strings[i - 1], strings[i]
        assert common[i] == next((k for k in range(50) if a[k] != b[k]), 50)


def near_by_force(rows, width, percent):
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
        sets.setdefault(doc_id, []).append(grams)
    ids = [i for i in sets if i is not None]
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    out = []
    for doc_id, grams in ((i, g) for i, all_ in sets.items() for g in all_):
        component = None if doc_id is None else top(doc_id)
        out.append((doc_id, len(grams), component, doc_id == component))
    return sorted(out, key=str)


def near_texts(seed, copies):
    rng = random.Random(seed)
    fresh = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, n = [], 0
    for size in (1, 1, 2, 3, 8, copies):
        base = [fresh() for _ in range(rng.randrange(20, 120))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randrange(max(1, len(words) // 18))):
                words[rng.randrange(len(words))] = fresh()
            rows.append((n * 7 % 1009, " ".join(words).upper() if rng.random() < 0.3 else "\n".join(words)))
            n += 1
    rows += [(2000, rows[3][1]), (2001, rows[3][1] + " "), (2002, None), (2003, ""), (2004, " \t"), (2005, "one"), (2006, "One"), (2007, "one two"), (None, rows[3][1])]
    rows += [(2008, rows[0][1]), (2008, rows[9][1])]
    return rows


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 3, 85), (2, 5, 80)])
def test_near_duplicates_equal_force(spark, monkeypatch, seed, width, percent):
    monkeypatch.setattr(tensored_minhash, "PIECE_DOCS", 16)  # the largest group is cut into pieces
    rows = near_texts(seed, 90)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, v string, root long")
    found = tensored_minhash.near_duplicates(docs.repartition(3), width, percent).collect()
    assert sorted((tuple(r) for r in found), key=str) == near_by_force(rows, width, percent)


def test_near_duplicates_of_nothing(spark):
    assert tensored_minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).isEmpty()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 100), (7, 7), (200, 200), (None, 3), (101, 100)]
    found = {r.v: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
