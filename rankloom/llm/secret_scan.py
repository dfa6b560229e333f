"""Secrets in texts: fixed patterns, and values in credential context that are hard to guess.

How hard a value is to guess is the cost of its cheapest segmentation: dynamic programming over its
characters, where each span is a word, a date, a repeat, a keyboard walk or brute force, and costs
the decimal logarithm of the guesses that it takes to hit upon it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from rankloom.llm import batches

# Fixed patterns of the base spans.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
SHORTEST_VALUE, SHORTEST_ACCESS, SHORTEST_HEX = 12, 18, 16
# A run of at least so many characters is matched at once: a shorter one fails and ends where it ends.
LONG_ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{SHORTEST_ACCESS - 4},}}")
LONG_HEX = re.compile(rf"[0-9a-f]{{{SHORTEST_HEX},}}")
KINDS = ("assign", "access", "hex", "guess")

# Context in which a value is a credential; wider than ASSIGN in its names and characters.
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)|pwd|secret|token|credential|api[_-]?key|access[_-]?key|private[_-]?key)["']?\x20*(?::|=|\x20is\x20)\x20*["']?([^\s"'<>,;]{6,})""",
    re.IGNORECASE | re.ASCII,
)
NAMES = re.compile("pass|pwd|secret|token|key|credential", re.IGNORECASE | re.ASCII)
# Log10 of the guesses from which a value counts as a secret.
HARD = 8.0
# Values up to here are priced in full and remembered; of longer ones only the verdict is worked out.
PRICED = 128

# Common words of passwords, most common first; the rank is the cost. Fixed values.
WORDS = (
    "password the and you admin qwerty letmein welcome monkey dragon login master hello love secret user test "
    "root pass word access changeme default guest account summer winter spring autumn shadow sunshine princess "
    "football baseball hockey soccer tiger eagle falcon batman superman computer internet server system network "
    "database token value none null true false example sample your here must should enter please insert string "
    "key name file path home work office company january february march april may june july august september "
    "october november december monday tuesday wednesday thursday friday saturday sunday red blue green black white "
    "orange purple silver gold apple banana cherry lemon coffee music money power freedom"
).split()
RANKS = {word: i + 1 for i, word in enumerate(WORDS)}
LONGEST_WORD = max(map(len, WORDS))
KEYBOARD = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz")
NEXT = {(a, b) for row in KEYBOARD for a, b in zip(row, row[1:])}
NEXT |= {(b, a) for a, b in NEXT}
DATE = re.compile(r"(?:19|20)\d\d(?:[-./]?(?:0[1-9]|1[0-2])(?:[-./]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0?[1-9]|[12]\d|3[01])[-./](?:0?[1-9]|1[0-2])[-./](?:19|20)?\d\d")
PLAIN = str.maketrans("4301$5@7", "aeoissat")


def alphabet(value: str) -> int:
    """How many characters a guesser tries for each place of a brute-force span."""
    size = 0
    for test, many in ((str.islower, 26), (str.isupper, 26), (str.isdigit, 10)):
        size += many * any(map(test, value))
    return size + 33 * any(not c.isalnum() for c in value) or 1


def words_and_dates(value: str, small: str, plain: str, i: int) -> Iterator[tuple[int, int, float]]:
    for j in range(i + 3, min(len(value), i + LONGEST_WORD) + 1):
        rank = RANKS.get(small[i:j]) or RANKS.get(plain[i:j])
        if rank:
            twisted = (small[i:j] not in RANKS) + (value[i:j] != small[i:j])
            yield i, j, math.log10(2 * rank) + 0.7 * twisted
    if found := DATE.match(value, i):
        yield i, found.end(), math.log10(366 * 120) if found.end() - i > 4 else math.log10(120)


def spans(value: str) -> Iterator[tuple[int, int, float]]:
    """Spans ``(start, end, cost)`` that are cheaper to guess than by brute force."""
    small = value.lower()
    plain = small.translate(PLAIN)
    n = len(value)
    for i in range(n):
        yield from words_and_dates(value, small, plain, i)
        for size in range(1, 5):
            j = i + size
            while value[j : j + size] == value[i : i + size] and j + size <= n:
                j += size
            if j - i >= max(3, 2 * size):
                yield i, j, size * math.log10(alphabet(value[i : i + size])) + math.log10((j - i) // size)
        j = i + 1
        while j < n and (small[j - 1], small[j]) in NEXT:
            j += 1
        for end in range(i + 3, j + 1):
            yield i, end, math.log10(50) + math.log10(end - i) + 0.3 * (small[i:end] != value[i:end])


@lru_cache(maxsize=10_000)
def guess_cost(value: str) -> float:
    """Log10 of the guesses of the cheapest segmentation. Each further span doubles the guesses."""
    n = len(value)
    single = math.log10(alphabet(value))
    ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for start, end, cost in spans(value):
        ending[end].append((start, cost))
    # cheapest[i][brute]: cost of the first i characters, and whether the last span is brute force.
    cheapest = [[math.inf, math.inf] for _ in range(n + 1)]
    cheapest[0] = [0.0, math.inf]
    joint = math.log10(2)
    for i in range(1, n + 1):
        before = cheapest[i - 1]
        cheapest[i][1] = min(before[1] + single, before[0] + single + joint)
        for start, cost in ending[i]:
            cheapest[i][0] = min(cheapest[i][0], min(cheapest[start]) + cost + joint)
    return min(cheapest[n])


def long_is_hard(value: str, hard: float) -> bool:
    """``guess_cost(value) >= hard``, in time and memory that stay in proportion to the length.

    Only costs below ``hard`` are carried on. When none is left, no further characters can bring the
    value below ``hard``, and the rest is not priced.
    """
    n, joint, single = len(value), math.log10(2), math.log10(alphabet(value))
    small = value.lower()
    plain = small.translate(PLAIN)
    ahead: dict[int, float] = {}  # the cheapest span by its end
    furthest = 0
    span, brute = 0.0, math.inf
    same = [0] * 5  # up to where each character equals the one ``size`` places on
    walks: list[tuple[int, float]] = []  # starts in the present keyboard walk, and the cost up to there
    twisted = -1  # the last capital
    for i in range(n + 1):
        if i:
            brute = min(brute + single, span + single + joint)
            span = ahead.pop(i, math.inf)
            if value[i - 1] != small[i - 1]:
                twisted = i - 1
            for start, cost in walks:
                if i - start >= 3:
                    span = min(span, cost + (math.log10(50) + math.log10(i - start) + 0.3 * (twisted >= start)) + joint)
            if i < n and (small[i - 1], small[i]) not in NEXT:
                walks = []
            walks = [w for w in walks if w[1] + math.log10(50 * max(i - w[0], 3)) + joint < hard]
        least = min(span, brute)
        if least >= hard:
            if i >= furthest and not walks:
                return True
            continue
        if i == n:
            return False
        # A start is of no use where an earlier one gives every later end as cheaply.
        if all(cost + math.log10(i + 3 - start) + 0.3 > least + math.log10(3) for start, cost in walks):
            walks.append((i, least))
        cheap = list(words_and_dates(value, small, plain, i))
        for size in range(1, 5):
            k = max(same[size], i)
            while k + size < n and value[k] == value[k + size]:
                k += 1
            same[size] = k
            j = i + size + (k - i) // size * size
            if j <= n and j - i >= max(3, 2 * size):
                cheap.append((i, j, size * math.log10(alphabet(value[i : i + size])) + math.log10((j - i) // size)))
        for _, end, cost in cheap:
            cost = least + cost + joint
            if cost < hard:
                ahead[end] = min(ahead.get(end, math.inf), cost)
                furthest = max(furthest, end)
    return True


def is_hard(value: str, hard: float) -> bool:
    return guess_cost(value) >= hard if len(value) <= PRICED else long_is_hard(value, hard)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns; kind is an index into ``KINDS``."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= SHORTEST_VALUE]
    found += [(m.start(), 1, m.end()) for m in LONG_ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def guessed_spans(text: str, hard: float) -> list[tuple[int, int, int]]:
    """Values in credential context whose cost reaches ``hard``."""
    return [(m.start(1), 3, m.end(1)) for m in CONTEXT.finditer(text) if is_hard(m[1], hard)]


def all_spans(text: str, hard: float = HARD) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base and guessed spans together."""
    base = base_spans(text)
    if not NAMES.search(text):
        return base, base
    return base, sorted(base + guessed_spans(text, hard))


def written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def scan(docs: DataFrame, hard: float = HARD) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans)`` of ``docs(doc_id, text)``.

    ``spans`` lists kind:start:end in code points, end exclusive, by start and kind. A null text
    counts as empty and has no spans; repeated rows and null ids are kept; texts are scanned whole,
    and values in credential context are marked whole, however long.
    """

    def scanned(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(rows):
            out: list[tuple] = []
            for text in batches.text_of(part).to_pylist():
                base, every = all_spans(text, hard)
                kinds = [kind for _, kind, _ in every]
                out.append((*map(kinds.count, range(4)), hashlib.sha256(written(base).encode()).hexdigest(), written(every)))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scanned,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string",
    )


def redacted(text: str, mark: str, hard: float = HARD) -> str:
    """The text with every stretch of touching or overlapping spans replaced by ``mark``.

    Of an assignment the value goes; its name stays.
    """
    pieces, done = [], 0
    for start, kind, end in all_spans(text, hard)[1]:
        if kind == 0:
            start = ASSIGN.match(text, start).start(2)
        if end <= done:
            continue
        if start > done or not pieces:
            pieces += [text[done:start], mark]
        done = end
    return "".join([*pieces, text[done:]])


def redact(docs: DataFrame, mark: str = "[SECRET]", hard: float = HARD) -> DataFrame:
    """``docs`` with the same rows and columns, secrets in ``text`` replaced; null texts stay null."""

    def replaced(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches.slices(rows):
            texts = [None if t is None else redacted(t, mark, hard) for t in part.column("text").to_pylist()]
            at = part.schema.get_field_index("text")
            yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return docs.mapInArrow(replaced, docs.schema)
