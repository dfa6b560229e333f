"""A full-text index of suffix ranks over a delimited vocabulary, searched for many patterns at once.

All words stand in one circular text, each behind a delimiter. A pattern is matched from its right
end to the left; the rotations that start with what is matched so far are an interval of ranks. The
index of the reversed words matches from left to right: with both, either half of a word can be
matched exactly first, and the other half after it with one error.
"""

from __future__ import annotations

import numpy as np

# Queries that are searched side by side; bounds the intervals held at once.
QUERIES_AT_ONCE = 4096
# Steps between two searches for equal states: in a run of one symbol all places of an error are equal.
EQUAL_STATES = 16


class Words:
    """Words as code points: all symbols in a row, and where each word starts."""

    def __init__(self, words: list[str], backwards: bool = False) -> None:
        self.symbols = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.cumsum(self.lengths) - self.lengths
        if backwards:
            last = np.repeat(2 * self.starts + self.lengths - 1, self.lengths)
            self.symbols = self.symbols[last - np.arange(len(self.symbols))]


class SuffixRanks:
    """The index of distinct words. Symbol 0 is the delimiter."""

    def __init__(self, words: Words) -> None:
        self.alphabet, dense = np.unique(words.symbols, return_inverse=True)
        count = len(words.lengths)
        text = np.zeros(len(dense) + count, np.int64)
        delimiters = words.starts + np.arange(count)
        inside = np.ones(len(text), bool)
        inside[delimiters] = False
        text[inside] = dense + 1
        order = sorted_rotations(text)
        self.size, self.words = len(text), count
        before = text[order - 1]
        # Ranks by the symbol before them: rank i behind symbol c moves to the place of (c, i).
        self.keys = np.sort(before * self.size + np.arange(self.size), kind="stable")
        self.before = before
        # The word whose delimiter has each of the first ranks.
        self.word = np.searchsorted(delimiters, order[:count])

    def dense(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols of this index; those that it does not have get one that matches nothing."""
        place = np.searchsorted(self.alphabet, symbols)
        known = self.alphabet[np.minimum(place, len(self.alphabet) - 1)] == symbols
        return np.where(known, place + 1, len(self.alphabet) + 1)

    def step(self, symbol: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """One end of an interval after its pattern has grown by ``symbol`` on the left."""
        return np.searchsorted(self.keys, symbol * self.size + rank)


def sorted_rotations(text: np.ndarray) -> np.ndarray:
    """Starts of all rotations of ``text`` in order, by prefix doubling."""
    rank, reach = text, 1
    while True:
        _, rank = np.unique(rank, return_inverse=True)
        if reach > 1 and rank.max() == len(text) - 1 or reach > 2 * len(text):
            return np.argsort(rank, kind="stable")
        rank = rank * len(text) + np.roll(rank, -reach)
        reach *= 2


def one_error(index: SuffixRanks, queries: Words, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a word of the index that differ by one symbol inserted, deleted or replaced.

    The last ``exact`` symbols of a query are matched as they are, the error lies before them.
    """
    found = [
        chunk_with_one_error(index, queries, exact, np.arange(at, min(at + QUERIES_AT_ONCE, len(exact))))
        for at in range(0, len(exact), QUERIES_AT_ONCE)
    ]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate(found))
    return pairs // index.words, pairs % index.words


def chunk_with_one_error(index: SuffixRanks, queries: Words, exact: np.ndarray, query: np.ndarray) -> np.ndarray:
    """``query * words + word`` for the given queries, some more than once."""
    symbols = index.dense(queries.symbols)
    left = queries.lengths[query]
    low, high = np.zeros(len(query), np.int64), np.full(len(query), index.words)
    goal = left - exact[query]
    found = []
    # The exact part: every query that has not reached its goal takes one symbol.
    while len(query) and (left > goal).any():
        move = left > goal
        c = symbols[queries.starts[query[move]] + left[move] - 1]
        low[move], high[move] = index.step(c, low[move]), index.step(c, high[move])
        left = left - move
        query, left, goal, low, high = (x[high > low] for x in (query, left, goal, low, high))
    # The other part: spend the error here, or match one more symbol and go on. States that have spent
    # it go on side by side, whenever they did.
    nothing = np.zeros(0, np.int64)
    spent = (nothing, nothing, nothing, nothing)
    steps = 0
    while len(query) or len(spent[0]):
        steps += 1
        if steps % EQUAL_STATES == 0:
            spent = tuple(np.unique(np.stack(spent), axis=1))
        some = np.flatnonzero(left > 0)
        c = np.full(len(query), -1)
        c[some] = symbols[queries.starts[query[some]] + left[some] - 1]
        of, symbol, grown_low, grown_high = extensions(index, low, high)
        other = np.flatnonzero((left[of] > 0) & (symbol != c[of]))
        words, spent = one_step(index, queries, symbols, *spent)
        found.append(words)
        new = [
            spent,
            (query[of], left[of], grown_low, grown_high),
            (query[of[other]], left[of[other]] - 1, grown_low[other], grown_high[other]),
            (query[some], left[some] - 1, low[some], high[some]),
        ]
        spent = tuple(np.concatenate(x) for x in zip(*new))
        low, high = index.step(c[some], low[some]), index.step(c[some], high[some])
        query, left = query[some], left[some] - 1
        query, left, low, high = (x[high > low] for x in (query, left, low, high))
    return np.unique(np.concatenate(found)) if found else nothing


def extensions(index: SuffixRanks, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Every growth of the intervals by one symbol: the interval's number, the symbol, the new interval.

    Intervals with fewer ranks than there are symbols are taken rank by rank.
    """
    letters = len(index.alphabet)
    wide = np.flatnonzero(high - low > letters)
    narrow = np.flatnonzero(high - low <= letters)
    of = np.repeat(wide, letters)
    symbol = np.tile(np.arange(1, letters + 1), len(wide))
    wide_low, wide_high = index.step(symbol, low[of]), index.step(symbol, high[of])
    sizes = (high - low)[narrow]
    single = np.repeat(narrow, sizes)
    rank = np.arange(len(single)) + np.repeat(low[narrow] - (np.cumsum(sizes) - sizes), sizes)
    letter = index.before[rank]
    place = index.step(letter, rank)
    some, real = wide_high > wide_low, letter > 0
    return (
        np.concatenate([of[some], single[real]]),
        np.concatenate([symbol[some], letter[real]]),
        np.concatenate([wide_low[some], place[real]]),
        np.concatenate([wide_high[some], place[real] + 1]),
    )


def one_step(
    index: SuffixRanks, queries: Words, symbols: np.ndarray, query: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Match one more symbol, or the delimiter: ``query * words + word`` of what ends, and the rest."""
    inside = left > 0
    c = np.zeros(len(query), np.int64)
    c[inside] = symbols[queries.starts[query[inside]] + left[inside] - 1]
    low, high = index.step(c, low), index.step(c, high)
    some = high > low
    # Behind the delimiter there is one rank for each word, and words are distinct.
    last, more = some & ~inside, some & inside
    return query[last] * index.words + index.word[low[last]], (query[more], left[more] - 1, low[more], high[more])
