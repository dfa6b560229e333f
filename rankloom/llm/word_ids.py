"""Token ids of whole texts, made word by word with a memory of words.

For tokenizers that drop white space and let no token reach across it, a text's ids are the ids of
its words in a row. Splitting a batch, finding its distinct words and gluing the ids together are
vector operations; the tokenizer itself sees each new word once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from rankloom.llm import batches

# Words that a worker remembers: the first ones that it meets, which are mostly the frequent ones.
MEMORY_WORDS = 600_000
LONGEST_REMEMBERED = 64
SLICE_BYTES = 4 << 20
# Byte classes: 0 white space, 1 the rest, 2 punctuation that may be cut off the end of a word.
# Quotes and the characters of special strings stay with their word.
CLASSES = np.ones(256, np.uint8)
CLASSES[list(b" \t\n\v\f\r")] = 0
CLASSES[list(b".,!?;:*$%&#")] = 2
ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])
LOWER = np.array([ord(chr(b).lower()) if b < 128 else b for b in range(256)], np.uint8)


def words_of(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """Words of all texts in a row, and the number of words before each text and after the last.

    A run of punctuation that ends a word behind an ASCII letter or digit is a word of its own:
    the pre-tokenizer cuts there in any case. ASCII capitals become small where no character that
    could combine with them follows and no special string can be near.
    """
    data, offsets = batches.bytes_and_offsets(texts)
    if len(data) == 0:
        return pa.array([], pa.large_string()), np.zeros(len(offsets), np.int64)
    kind = CLASSES[data]
    solid = kind != 0
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    first = first[:-1]
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:]
    cut = np.flatnonzero((kind[1:] == 2) & ALNUM[data[:-1]] & ~first[1:]) + 1
    ends_of_runs = np.flatnonzero((kind == 2) & np.append(kind[1:] != 2, True)) + 1
    after = ends_of_runs[np.searchsorted(ends_of_runs, cut, side="right")] if len(cut) else cut
    ends = offsets[np.searchsorted(offsets, cut, side="right")]
    trailing = (after >= ends) | (np.append(kind, 0)[after] == 0)
    start[cut[trailing]] = True
    if b"<|" not in data.tobytes():
        plain = np.append(data[1:] < 128, True)
        data = np.where(plain, LOWER[data], data)
    places = np.flatnonzero(start)
    kept = data[solid]
    edges = np.append(np.flatnonzero(start[solid]), len(kept))
    words = pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(edges), pa.py_buffer(kept))
    return words, np.searchsorted(places, offsets)


class WordEncoder:
    """Encodes batches with the tokenizers library, without added special tokens.

    Special strings inside texts become special ids, the library's default. Files whose
    pre-tokenizer keeps white space are encoded text by text instead.
    """

    def __init__(self, file: str, remember: int | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(file, encoding="utf-8") as text:
            self.by_word = drops_space(json.load(text))
        self.remember = MEMORY_WORDS if remember is None else remember
        self.memory: dict[str, int] = {}
        # Where each word's ids start in ``ids``; behind the remembered words lie those of one batch.
        self.starts = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.words = 0

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            counts = np.fromiter((len(e) for e in found), np.int64, len(found))
            return np.fromiter((i for e in found for i in e.ids), np.uint32, int(counts.sum())), counts
        words, edges = words_of(texts)
        words = words.dictionary_encode()
        starts, lengths = self.lookup(words.dictionary.to_pylist())
        codes = words.indices.to_numpy()
        per_word = lengths[codes]
        ids = self.ids[batches.gather(starts[codes], per_word)]
        ends = np.concatenate([[0], np.cumsum(per_word)])
        return ids, np.diff(ends[edges])

    def lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word start in ``ids``, and how many they are."""
        known = list(map(self.memory.get, words))
        new = [i for i, place in enumerate(known) if place is None]
        kept: list[int] = []
        for i in new:
            if len(self.memory) < self.remember and len(words[i]) <= LONGEST_REMEMBERED:
                known[i] = self.memory[words[i]] = self.words + len(kept)
                kept.append(i)
        passing = [i for i in new if known[i] is None]
        for i, place in zip(passing, range(self.words + len(kept), self.words + len(new))):
            known[i] = place
        self.store([words[i] for i in kept + passing])
        places = np.array(known, np.int64)
        starts, ends = self.starts[places], self.starts[places + 1]
        self.words += len(kept)
        return starts, ends - starts

    def store(self, words: list[str]) -> None:
        """Encode ``words`` and put their ids behind those of the remembered words."""
        place, used = self.words, int(self.starts[self.words])
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            # One text of many words costs less than many texts; offsets tell whose each token is.
            coded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = coded.ids
            bounds = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            begins = np.fromiter((begin for begin, _ in coded.offsets), np.int64, len(ids))
            sizes = np.bincount(np.searchsorted(bounds, begins, side="right"), minlength=len(part))
            ends = used + np.cumsum(sizes)
            self.starts = grown(self.starts, place + len(part) + 1)
            self.ids = grown(self.ids, int(ends[-1]))
            self.starts[place + 1 : place + 1 + len(part)] = ends
            self.ids[used : ends[-1]] = ids
            place, used = place + len(part), int(ends[-1])


def grown(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size - len(array), len(array) // 2), array.dtype)])


def drops_space(described: dict) -> bool:
    """Whether white space ends every token and is not part of any, as far as the file's own words tell."""

    def steps(part: dict | None, key: str) -> list[dict]:
        return [] if part is None else part.get(key, [part])

    before = steps(described.get("pre_tokenizer"), "pretokenizers")
    apart = any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] and "[^\\s" in s["pattern"].get("Regex", "") for s in before)
    plain = all(s.get("add_prefix_space", False) is False for s in before)
    normal = {"NFC", "NFD", "Replace", "Lowercase"}
    return apart and plain and all(s["type"] in normal for s in steps(described.get("normalizer"), "normalizers"))


@lru_cache(maxsize=2)
def encoder(file: str, remember: int | None = None) -> WordEncoder:
    return WordEncoder(file, remember)


def cut_at_space(texts: pa.LargeStringArray) -> Iterator[pa.LargeStringArray]:
    """One text in pieces of about ``SLICE_BYTES``, cut before white space; longer ones where there is none."""
    data, _ = batches.bytes_and_offsets(texts)
    start = 0
    while len(data) - start > SLICE_BYTES:
        end = start + SLICE_BYTES
        while end < len(data):
            white = np.flatnonzero(CLASSES[data[end : end + SLICE_BYTES]] == 0)
            if len(white):
                end += int(white[0])
                break
            end = min(end + SLICE_BYTES, len(data))
        yield pa.array([data[start:end].tobytes()], pa.large_binary()).cast(pa.large_string())
        start = end
    yield pa.array([data[start:].tobytes()], pa.large_binary()).cast(pa.large_string())


def encoded(
    rows: Iterator[pa.RecordBatch], file: str, end_id: int, remember: int | None = None, slice_bytes: int | None = None
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """For each slice of rows: the slice, its ids with ``end_id`` behind every text, and counts with it.

    ``remember`` words and slices of ``slice_bytes`` bound the memory; they change no id.
    """
    coder = encoder(file, remember)
    for part in batches.slices(rows, limit=slice_bytes or SLICE_BYTES):
        texts = batches.text_of(part)
        if coder.by_word and len(texts) == 1:
            found = [coder.encode(piece)[0] for piece in cut_at_space(texts)]
            ids = np.concatenate(found)
            counts = np.array([len(ids)])
        else:
            ids, counts = coder.encode(texts)
        yield part, np.insert(ids, np.cumsum(counts), end_id), counts + 1
