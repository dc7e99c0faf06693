"""Byte-level BPE by prefix dynamic programming, and its inverse.

For each prefix of a byte string there is exactly one token that its encoding can end with: one whose
bytes end the prefix, that encodes to itself, and that may follow the last token of what is before it.
Whether two tokens may stand side by side is seen by undoing their merges, latest first, and asking each
time whether the ranks would have merged across the boundary instead. The table of last tokens gives the
encoding from the end backwards, in time linear in the bytes; new bytes only add to it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.tokens import PieceEncoder, piece_of

#: Answers about pairs of tokens that are remembered; this bounds memory only.
PAIRS = 500_000
#: Documents encoded, and decoded, at a time.
DOCS, DECODED = 2048, 256


def read_ranks(path: str) -> dict[bytes, int]:
    """From a file with a base64 byte string and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


class Vocabulary:
    """Ranks of byte strings; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.bytes = ranks, {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self._parts: dict[int, tuple[int, int] | None | bool] = {}
        #: For each last token the tokens asked about, and how many answers there are.
        self.after: dict[int, dict[int, bool]] = {}
        self._answers = 0
        #: A trie: by byte, the token that its bytes are, or -1, and what goes on below it.
        self.trie: dict[int, tuple[int, dict]] = {}
        for token, rank in ranks.items():
            level = self.trie
            for byte in token[:-1]:
                level = level.setdefault(byte, (-1, {}))[1]
            level[token[-1]] = (rank, level[token[-1]][1] if token[-1] in level else {})

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        return cls(read_ranks(path))

    def parts(self, token: int) -> tuple[int, int] | None | bool:
        """The two tokens whose merge makes this one; None for a byte; False if its bytes encode otherwise."""
        if token not in self._parts:
            whole = self.bytes[token]
            row = [bytes((b,)) for b in whole]
            while len(row) > 2:
                rank, at = min((self.ranks.get(a + b, len(self.ranks)), i) for i, (a, b) in enumerate(zip(row, row[1:])))
                if rank >= token:
                    break
                row[at : at + 2] = [row[at] + row[at + 1]]
            if len(row) == 1:
                self._parts[token] = None
            else:
                self._parts[token] = tuple(self.ranks[x] for x in row) if len(row) == 2 else False
        return self._parts[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes is these two tokens; ``left`` is -1 at the start."""
        if self._answers >= PAIRS:
            self._answers = 0
            for row in self.after.values():  # rows may be in use
                row.clear()
        row = self.after.setdefault(left, {})
        known = row.get(right)
        if known is None:
            self._answers += 1
            known = row[right] = self.parts(right) is not False and (left < 0 or self._holds(left, right))
        return known

    def _holds(self, a: int, b: int) -> bool:
        before = len(self.ranks)  # merges across the boundary of lower rank than this would have come first
        while True:
            across = self.ranks.get(self.bytes[a] + self.bytes[b])
            if across is not None and across < before:
                return False
            parts_a, parts_b = self.parts(a), self.parts(b)
            if parts_a and (not parts_b or a > b):
                before, a = a, parts_a[1]
            elif parts_b:  # of equal ranks the left merge came first, so one across comes before this
                before, b = b + 1, parts_b[0]
            else:
                return True


class PrefixTable:
    """The last token of each byte prefix of one string that is encoded as a whole."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Adds bytes at the end. What the table holds stays as it is."""
        v, old = self.vocabulary, len(self.data)
        self.data += more
        data, last, size = self.data, self.last, len(self.data)
        last.extend([-1] * len(more))
        for start in range(max(0, old - v.longest + 1), size):
            before, level = last[start], v.trie
            known = v.after.setdefault(before, {})
            for end in range(start, size):
                hit = level.get(data[end])
                if hit is None:
                    break
                token, level = hit
                if token < 0 or last[end + 1] >= 0 or end < old:
                    continue
                fits = known.get(token)
                if fits or fits is None and v.may_follow(before, token):
                    last[end + 1] = token

    def truncate(self, size: int) -> None:
        self.data = self.data[:size]
        del self.last[size + 1 :]

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Puts ``new`` in place of the bytes from ``start`` to ``end``. The table before ``start`` is kept."""
        tail = self.data[end:]
        self.truncate(start)
        self.append(new + tail)

    def tokens(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.bytes[out[-1]])
        return out[::-1]


class TextEncoder:
    """Encodes each match of ``pattern`` separately."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        import regex

        self.vocabulary, self.match = vocabulary, regex.compile(pattern)

    def _ids(self, match: str) -> list[int]:
        data = match.encode()
        whole = self.vocabulary.ranks.get(data)
        return [whole] if whole is not None else PrefixTable(self.vocabulary, data).tokens()

    def encode(self, text: str) -> list[int]:
        return [i for m in self.match.finditer(text) for i in self._ids(m[0])]


class EditableText:
    """A text with its ids, kept right under appends and edits without encoding it anew."""

    def __init__(self, encoder: TextEncoder, text: str = "") -> None:
        self.encoder, self.text, self.cuts, self.tables = encoder, "", [], []
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Matches that end two characters or more before the edit stay, as do those after it from where cuts meet again."""
        old, moved = self.text, len(new) - (end - start)
        self.text = old[:start] + new + old[end:]
        first = 0
        while first < len(self.cuts) and self.cuts[first][1] < start:
            first += 1
        first = max(0, first - 1)
        at = self.cuts[first][0] if self.cuts else 0
        starts = {a: k for k, (a, _) in enumerate(self.cuts) if a >= end}
        cuts, tables, resume = [], [], len(self.cuts)
        for m in self.encoder.match.finditer(self.text, at):
            if m.start() - moved in starts and m.start() >= start + len(new):
                resume = starts[m.start() - moved]
                break
            data, k = m[0].encode(), first + len(cuts)
            table = None
            if k < len(self.cuts) and m.start() == self.cuts[k][0] < start and data.startswith(self.tables[k].data):
                table = self.tables[k]  # grown at its end, as by an append
                table.append(data[len(table.data) :])
            tables.append(table or PrefixTable(self.encoder.vocabulary, data))
            cuts.append((m.start(), m.end()))
        self.cuts[first:] = cuts + [(a + moved, z + moved) for a, z in self.cuts[resume:]]
        self.tables[first:] = tables + self.tables[resume:]

    def tokens(self) -> list[int]:
        return [i for table in self.tables for i in table.tokens()]


@lru_cache(maxsize=2)  # a Python worker's tasks share the vocabulary and what has been learnt
def piece_encoder(ranks_path: str, pattern: str) -> PieceEncoder:
    matches = TextEncoder(Vocabulary.load(ranks_path), pattern)

    def encode_keys(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [matches.encode(piece_of(k)) for k in keys.to_pylist()]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), "<u4", sizes.sum()), sizes

    return PieceEncoder(encode_keys)


@lru_cache(maxsize=2)
def _byte_table(ranks_path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(ranks_path).items()}


def encode(
    documents: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text: str = "text", ids: str = "ids"
) -> DataFrame:
    """``id_col, ids`` (array<int>) for each row. A null or empty text has no ids; repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(ranks_path, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS):
                rows = batch.slice(first, DOCS)
                found = list(encoder.encode(rows.column(1).to_pylist()))
                flat = pa.Array.from_buffers(pa.int32(), sum(map(len, found)) // 4, [None, pa.py_buffer(b"".join(found))])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.ListArray.from_arrays(_offsets(len(f) // 4 for f in found), flat)], names=[id_col, ids]
                )
                del rows, found, flat
                pa.default_memory_pool().release_unused()

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, `{ids}` array<int>")


def _offsets(sizes: Iterable[int]) -> pa.Array:
    ends = [0]
    for n in sizes:
        ends.append(ends[-1] + n)
    return pa.array(ends, pa.int32())


def decode(rows: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of ``ids`` as binary column ``out``; null ids give null, an unknown id ends the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _byte_table(ranks_path)
        for batch in batches:
            for first in range(0, batch.num_rows, DECODED):
                part = batch.slice(first, DECODED)
                lists = part.column(part.schema.get_field_index(ids)).to_pylist()
                data = [None if x is None else b"".join(map(table.__getitem__, x)) for x in lists]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], names=[*part.schema.names, out])
                del part, lists, data
                pa.default_memory_pool().release_unused()

    kept = rows.drop(out)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{schema}, `{out}` binary")


def digests(rows: DataFrame, id_col: str = "doc_id", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``id_col, n_tokens, ids_sha256`` (of the decimal ids joined by one space) and ``decoded_sha256``."""
    joined = F.array_join(F.col(ids).cast("array<string>"), " ")
    return rows.select(
        id_col,
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    )
