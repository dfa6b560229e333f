"""Token counts by byte-pair merging with a heap over a linked list of symbols.

Only counts are made, no identifiers: a text has as many tokens as it has symbols at the start, less
one for each merge.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from rankloom.llm import batches

SPACE = "▁"
# Segments that a worker remembers; a full memory is emptied, which costs time and changes nothing.
MEMORY_SEGMENTS = 1_000_000
LONGEST_REMEMBERED = 48
PUNCTUATION = ".,!?;:*$%&#"


class Merger(dict):
    """Token counts of segments under one sentencepiece BPE model; also the memory of past counts.

    No piece has a space mark after another character, so a merge never reaches across the start of
    a run of spaces and each run with the characters behind it is a segment of its own. The same
    holds for a control character that no piece contains. ``__init__`` checks both on the model.
    """

    def __init__(self, model_file: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        super().__init__()
        model = proto.ModelProto()
        with open(model_file, "rb") as file:
            model.ParseFromString(file.read())
        normal = proto.ModelProto.SentencePiece.NORMAL
        spec, trainer = model.normalizer_spec, model.trainer_spec
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == normal}
        odd = {proto.ModelProto.SentencePiece.USER_DEFINED, proto.ModelProto.SentencePiece.UNUSED}
        across = any(SPACE in p.lstrip(SPACE) for p in self.rank)
        if (
            trainer.model_type != proto.TrainerSpec.BPE
            or not trainer.byte_fallback
            or trainer.treat_whitespace_as_suffix
            or spec.precompiled_charsmap
            or spec.remove_extra_whitespaces
            or not (spec.add_dummy_prefix and spec.escape_whitespaces)
            or any(p.type in odd for p in model.pieces)
            or across
        ):
            raise ValueError("needs a BPE model with byte fallback, identity normalisation and leading space marks")
        alone = "".join(c for c in "\t\n\r" if not any(c in p for p in self.rank))
        self.segments = re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" + (f"|[{alone}]" if alone else ""))

        self.neighbours = {p[i : i + 2] for p in self.rank for i in range(len(p) - 1)}

    def __missing__(self, segment: str) -> int:
        stem = segment.rstrip(PUNCTUATION)
        if 0 < len(stem) < len(segment) and segment[len(stem) - 1 : len(stem) + 1] not in self.neighbours:
            count = self[stem] + self[segment[len(stem) :]]  # no piece has these two characters in a row
        else:
            count = self.merged(segment)
        if len(segment) <= LONGEST_REMEMBERED:
            if len(self) >= MEMORY_SEGMENTS:
                self.clear()
            self[segment] = count
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        return sum(map(self.__getitem__, self.segments.findall(marked)))

    def merged(self, segment: str) -> int:
        """Pop the best adjacent pair until none is a piece; ties go to the leftmost pair."""
        rank = self.rank
        symbols: list[str] = list(segment)
        last = len(symbols) - 1
        following = list(range(1, last + 2))
        before = list(range(-1, last))
        heap = []
        for i in range(last):
            pair = symbols[i] + symbols[i + 1]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, left, pair = heapq.heappop(heap)
            right = following[left]
            if not symbols[left] or right > last or symbols[left] + symbols[right] != pair:
                continue  # one of the two has been merged meanwhile
            symbols[left], symbols[right] = pair, ""
            merges += 1
            after = following[left] = following[right]
            if after <= last:
                before[after] = left
                if (new := pair + symbols[after]) in rank:
                    heapq.heappush(heap, (rank[new], left, new))
            if (ahead := before[left]) >= 0 and (new := symbols[ahead] + pair) in rank:
                heapq.heappush(heap, (rank[new], ahead, new))
        # A character without a piece is as many tokens as it has bytes.
        spelled = sum(len(s.encode()) - 1 for s in symbols if len(s) == 1 and s not in rank)
        return last + 1 - merges + spelled


@lru_cache(maxsize=2)
def merger(model_file: str) -> Merger:
    return Merger(model_file)


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row of ``docs(doc_id, text)``.

    A null text counts as empty and has no tokens; a null doc_id is kept; repeated rows are counted
    once each. Texts of any length are counted whole. ``model_file`` must be readable on executors.
    """

    def counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merger(model_file)
        for part in batches.slices(rows):
            texts = batches.text_of(part)
            n = pa.array([model.count(t) for t in texts.to_pylist()], pa.int64())
            size = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
