"""Hierarchical packing of documents into sequences of several lengths.

Whole windows of the longest tier are cut off a document first. What is left goes to the shortest
tier that holds it. Tiers are packed from the longest down: each window takes the longest waiting
piece, its gap is filled with the longest pieces of shorter tiers that fit, and the last bit by cutting
the shortest one that is too long. So every window is full but one per task, which stays for the end.
Sequences of a tier are dealt to step groups of equal tokens so that their attention costs balance.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.tokens import library_encoder

TIERS = (256, 512, 1024, 2048)
#: Tokens of a step group: eight windows of 2048.
STEP_TOKENS = 16_384
#: Waiting tokens at which a task packs. It bounds memory; what doesn't fill a window waits on.
ROUND_TOKENS = 1 << 20
DOCS = 2048
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, tokens binary, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, tier int, step_id bigint"
)


class Piece(NamedTuple):
    doc: int | None
    start: int
    tokens: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.tokens) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return self._replace(tokens=self.tokens[: 4 * n]), self._replace(start=self.start + n, tokens=self.tokens[4 * n :])


class Waiting:
    """Pieces by length; the longest up to a length and the shortest over one are found in one step each."""

    def __init__(self) -> None:
        self.by_length: dict[int, list[Piece]] = {}
        self.lengths, self.tokens = 0, 0  # a bit for each length that has pieces

    def add(self, piece: Piece) -> None:
        self.by_length.setdefault(piece.length, []).append(piece)
        self.lengths |= 1 << piece.length
        self.tokens += piece.length

    def _take(self, length: int) -> Piece:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            self.lengths &= ~(1 << length)
        self.tokens -= length
        return piece

    def longest(self, most: int) -> Piece | None:
        found = self.lengths & ((2 << most) - 1)
        return self._take(found.bit_length() - 1) if found else None

    def shortest_over(self, length: int) -> Piece | None:
        found = self.lengths >> (length + 1)
        return self._take(length + (found & -found).bit_length()) if found else None


class Packer:
    """Packs one task's documents. ``feed`` and ``finish`` give finished step groups: lists of sequences."""

    def __init__(self, tiers: Sequence[int] = TIERS, step_tokens: int = STEP_TOKENS, round_tokens: int = ROUND_TOKENS):
        self.tiers, self.step_tokens, self.round_tokens = sorted(tiers), step_tokens, round_tokens
        self.waiting, self.ready = Waiting(), {t: [] for t in self.tiers}
        self.fresh = 0  # tokens in ready sequences

    def feed(self, doc: int | None, ids: bytes) -> Iterator[tuple[int, list[list[Piece]]]]:
        top, n = self.tiers[-1], len(ids) // 4
        for at in range(0, n, top):
            piece = Piece(doc, at, ids[4 * at : 4 * (at + top)], n)
            if piece.length < top:
                self.waiting.add(piece)
                break
            self._done(top, [piece])
            if self.fresh >= self.round_tokens:
                yield from self._steps(False)
        if self.waiting.tokens >= self.round_tokens:
            self._pack()
            yield from self._steps(False)

    def finish(self) -> Iterator[tuple[int, list[list[Piece]]]]:
        self._pack()
        left = []
        while (piece := self.waiting.longest(self.tiers[-1])) is not None:
            left.append(piece)
        if left:  # less than one window of the longest tier
            self._done(self.tiers[-1], left)
        yield from self._steps(True)

    def _done(self, tier: int, sequence: list[Piece]) -> None:
        self.ready[tier].append(sequence)
        self.fresh += sum(p.length for p in sequence)

    def _pack(self) -> None:
        top = self.tiers[-1]
        while (first := self.waiting.longest(top)) is not None:
            tier = self.tiers[bisect_left(self.tiers, first.length)]
            window, gap = [first], tier - first.length
            while gap:
                piece = self.waiting.longest(gap)
                if piece is None:
                    piece = self.waiting.shortest_over(gap)
                    if piece is None:
                        break
                    piece, rest = piece.cut(gap)
                    self.waiting.add(rest)
                window.append(piece)
                gap -= piece.length
            if gap:  # nothing waits any more
                for piece in window:
                    self.waiting.add(piece)
                return
            self._done(tier, window)

    def _steps(self, last: bool) -> Iterator[tuple[int, list[list[Piece]]]]:
        """Whole step groups of the ready sequences, dealt back and forth by falling attention cost."""
        for tier in reversed(self.tiers):
            each = max(1, self.step_tokens // tier)
            n = len(self.ready[tier]) // each
            now, self.ready[tier] = self.ready[tier][: n * each], self.ready[tier][n * each :]
            now.sort(key=lambda s: -sum(p.length**2 for p in s))
            groups: list[list[list[Piece]]] = [[] for _ in range(n)]
            for k, sequence in enumerate(now):
                lap, at = divmod(k, n)
                groups[at if lap % 2 == 0 else n - 1 - at].append(sequence)
            if last and self.ready[tier]:
                groups.append(self.ready[tier])
                self.ready[tier] = []
            yield from ((tier, g) for g in groups)
        self.fresh = sum(p.length for sequences in self.ready.values() for s in sequences for p in s)


def _rows(steps: Iterator[tuple[int, list[list[Piece]]]], part: int, counters: dict[str, int]) -> Iterator[pa.RecordBatch]:
    names = ("doc_id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset", "tier", "step_id")
    kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3 + [pa.int32(), pa.int64()]
    for tier, group in steps:
        rows = []
        for sequence in group:
            offset = 0
            for p in sequence:
                place = (part << 33 | counters["sequence"], offset, tier, part << 33 | counters["step"])
                rows.append((p.doc, p.start, p.length, p.tokens, p.doc_tokens, *place))
                offset += p.length
            counters["sequence"] += 1
        counters["step"] += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def pack(
    documents: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text: str = "text",
    tiers: Sequence[int] = TIERS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """A row for each piece: document, place in it, ids (little-endian, unsigned 32 bits), sequence, tier and step.

    Each document's ids, ``end_id`` last, lie in exactly one piece each; a null text is the end id alone.
    Every partition of ``documents`` packs on its own, without a shuffle, so at most one sequence per
    partition is not full. A sequence's ``tier`` is its length where it is full. Numbers of sequences
    and steps are unique over all partitions. Repeated rows are packed as often as they occur. An id that
    is no long counts as null. A special token's string in a text becomes that token.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, end = library_encoder(tokenizer), Packer(tiers, step_tokens), end_id.to_bytes(4, "little")
        part, counters = TaskContext.get().partitionId(), {"sequence": 0, "step": 0}
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS):
                rows = batch.slice(first, DOCS)
                for doc, ids in zip(rows.column(0).to_pylist(), encoder.encode(rows.column(1).to_pylist())):
                    yield from _rows(packer.feed(doc, ids + end), part, counters)
                del rows, ids
                pa.default_memory_pool().release_unused()
        yield from _rows(packer.finish(), part, counters)

    return documents.select(F.col(id_col).try_cast("bigint").alias(id_col), F.col(text)).mapInArrow(run, SCHEMA)
