"""Alignment of two tokenizers' tokens over the same bytes, and how many documents hold each linked pair of ids.

Tokens of both sides tile a document's bytes. Two tokens overlap if and only if the one that starts later
starts inside the other, so two as-of joins per batch, keyed by document, find all links: each token start
takes the other side's covering token, and the union of both directions is complete. Places where tokens
of both sides start together cut the document into groups.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.shared import most_frequent, written
from clickpulse.llm.tokens import Store, as_key, library_encode, piece_of, plain, words_of

#: Characters encoded, and tokens of both sides aligned, at a time; a longer text is a batch of its own.
ENCODED, ALIGNED = 2_000_000, 400_000
#: Documents taken from a batch at a time.
DOCS = 1_024
#: Pairs that occur in most documents, whose counts every task gets. The counts of all others are joined.
FREQUENT = 200_000
#: Marks the second side's ids, and a piece whose bytes a side doesn't give back.
SECOND, BROKEN = 1 << 31, (1 << 32) - 1
_CUT = re.compile(r"(?<=\S)(?= )")
SCHEMA = (
    "row bigint, `{0}` {1}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "pairs array<bigint>, times array<int>"
)


class Side:
    """The bytes of each of a vocabulary's tokens, and their number."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens, self.widths = tokens, np.array([len(t) for t in tokens], np.int64)


def _byte_letters() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself where it is printable, else from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_level_side(path: str) -> Side:
    from tokenizers import Tokenizer

    model, letters = Tokenizer.from_file(path), _byte_letters()
    tokens = [b""] * model.get_vocab_size()
    for token, number in model.get_vocab().items():
        tokens[number] = bytes(letters[c] for c in token)
    return Side(tokens)


def piece_side(model) -> Side:
    """Of a sentencepiece model: its space mark is a space, its byte pieces are bytes."""
    tokens = []
    for number in range(model.vocab_size()):
        piece = model.id_to_piece(number)
        tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace("▁", " ").encode())
    return Side(tokens)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``starts``, one run after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Encoders:
    """Both sides' ids of a space and a text. Pieces are cut before spaces, where neither side has a token across."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        import sentencepiece

        self._first = library_encode(byte_path, specials=False)
        self._second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.a, self.b = byte_level_side(byte_path), piece_side(self._second)
        pieces = [self._second.id_to_piece(i) for i in range(self._second.vocab_size())]
        #: No piece of the second side goes on after a space mark, or holds a line break.
        self.apart = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self._mark = self._second.piece_to_id("▁")
        self._store = Store(self._both)

    def _of_second(self, pieces: list[str]) -> list[list[int]]:
        """The library puts a space before each piece: the piece's own, or one to take out again."""
        found = self._second.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1)
        for k, piece in enumerate(pieces):
            if piece == " ":
                found[k] = [self._mark]
            elif piece[0] != " ":
                found[k] = found[k][1:] if found[k][0] == self._mark else [0]
        return found

    def _both(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each piece's ids of the first side, then of the second side with their mark."""
        pieces = list(map(piece_of, keys.to_pylist()))
        a, sizes_a = self._first(keys)
        second = self._of_second(pieces)
        sizes_b = np.fromiter(map(len, second), np.int64, len(second))
        b = np.fromiter(chain.from_iterable(second), np.int64, sizes_b.sum())
        data = [p.encode() for p in pieces]
        broken = self._differ(data, a, sizes_a, self.a) | self._differ(data, b, sizes_b, self.b)
        if broken.any():
            a, b = a[np.repeat(~broken, sizes_a)], b[np.repeat(~broken, sizes_b)]
            sizes_a, sizes_b = np.where(broken, 0, sizes_a), np.where(broken, 0, sizes_b)
        sizes = sizes_a + sizes_b + broken
        starts, out = np.cumsum(sizes) - sizes, np.full(sizes.sum(), BROKEN, "<u4")
        out[_runs(starts, sizes_a)] = a
        out[_runs(starts + sizes_a, sizes_b)] = b | SECOND
        return out, sizes

    @staticmethod
    def _differ(data: list[bytes], ids: np.ndarray, sizes: np.ndarray, side: Side) -> np.ndarray:
        """Whether a piece's tokens don't give back its bytes."""
        tokens = list(map(side.tokens.__getitem__, ids.tolist()))
        ends = np.cumsum(sizes)
        wide = np.concatenate([[0], np.cumsum(side.widths[ids])])
        if b"".join(tokens) == b"".join(data) and (wide[ends] == np.cumsum([len(d) for d in data])).all():
            return np.zeros(len(data), bool)
        return np.array([b"".join(tokens[z - n : z]) != d for d, n, z in zip(data, sizes.tolist(), ends.tolist())])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text the ids of both sides, the second's marked; nothing for empty texts and those that differ."""
        even = [self.apart and plain(t) for t in texts]
        of_even = self._even([t for t, p in zip(texts, even) if p]) if any(even) else iter(())
        found = [next(of_even) if p else self._uneven(t) for t, p in zip(texts, even)]
        self._store.trim()
        return [f[:0] if (f == BROKEN).any() else f for f in found]

    def _even(self, texts: list[str]) -> Iterator[np.ndarray]:
        words = words_of(texts)
        ids, ends = self._store.gather(self._store.places(words.different)[words.codes])
        return iter(np.split(ids, ends[words.offsets[1:-1] - 1]))

    def _uneven(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        pieces = _CUT.split(" " + text) if self.apart else [" " + text]
        keys = pa.array(map(as_key, pieces), pa.string()).dictionary_encode()
        return self._store.gather(self._store.places(keys.dictionary)[keys.indices.to_numpy()])[0]


@lru_cache(maxsize=1)  # a Python worker's tasks share what has been learnt
def encoders(byte_path: str, piece_path: str) -> Encoders:
    return Encoders(byte_path, piece_path)


class Tokens(NamedTuple):
    """One side's tokens of a batch: ids, the document of each, and its first byte counted over the batch."""

    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray


def _tokens(ids: np.ndarray, doc: np.ndarray, widths: np.ndarray) -> Tokens:
    wide = widths[ids]
    return Tokens(ids, doc, np.cumsum(wide) - wide)


def covering(a: Tokens, b: Tokens) -> np.ndarray:
    """For each token of ``a`` the number of the token of ``b`` that covers its first byte."""
    left = pd.DataFrame({"start": a.start, "doc": a.doc}, copy=False)
    right = pd.DataFrame({"start": b.start, "doc": b.doc, "at": np.arange(len(b.ids))}, copy=False)
    return pd.merge_asof(left, right, on="start", by="doc")["at"].to_numpy(np.int64)


def links(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the linked tokens of both sides, and for each token whether one of the other side starts with it."""
    over_a, over_b = covering(a, b), covering(b, a)
    with_b, with_a = b.start[over_a] == a.start, a.start[over_b] == b.start
    later = np.flatnonzero(~with_a)  # those that start together are in the first direction already
    return np.concatenate([np.arange(len(a.ids)), over_b[later]]), np.concatenate([over_a, later]), with_b, with_a


@lru_cache(maxsize=1)
def _digits(size_a: int, size_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Every id with each sign that may follow it, as rows of bytes and their lengths."""
    texts = [f"{i}{sign}" for i in range(size_a) for sign in ",|"] + [f"{i}{sign}" for i in range(size_b) for sign in (",", ";", "")]
    table = np.array([t.encode() for t in texts])
    return table.view(np.uint8).reshape(len(texts), -1), np.array([len(t) for t in texts], np.int32)


def rendered(a: Tokens, b: Tokens, with_b: np.ndarray, with_a: np.ndarray, docs: int, sizes: tuple[int, int]) -> pa.Array:
    """Each document's groups: ``a1,a2|b1;a3|b2,b3``."""
    group_a, group_b = np.cumsum(with_b) - 1, np.cumsum(with_a) - 1
    first_a, first_b = np.append(np.flatnonzero(with_b), len(a.ids)), np.append(np.flatnonzero(with_a), len(b.ids))
    last_a, last_b = np.append(with_b[1:], True), np.append(with_a[1:], True)
    ends = np.append(b.doc[1:] != b.doc[:-1], True)
    codes = np.empty(len(a.ids) + len(b.ids), np.int64)
    codes[np.arange(len(a.ids)) + first_b[group_a]] = a.ids * 2 + last_a
    codes[np.arange(len(b.ids)) + first_a[group_b + 1]] = 2 * sizes[0] + b.ids * 3 + last_b + ends
    table, lengths = _digits(*sizes)
    long = lengths[codes]
    text = table[codes][np.arange(table.shape[1]) < long[:, None]]
    tokens = np.bincount(a.doc, minlength=docs) + np.bincount(b.doc, minlength=docs)
    cuts = np.concatenate([[0], np.cumsum(long, dtype=np.int64)])[np.concatenate([[0], np.cumsum(tokens)])]
    return pa.Array.from_buffers(pa.string(), docs, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(text)])


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Exact sums of neighbouring runs of ``sizes`` values."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], np.cumsum(sizes)])])


def _aligned(coded: list[np.ndarray], sides: Encoders) -> list[pa.Array]:
    ids, docs = np.concatenate(coded), len(coded)
    doc = np.repeat(np.arange(docs), [len(c) for c in coded])
    second = ids >= SECOND
    a = _tokens(ids[~second].astype(np.int64), doc[~second], sides.a.widths)
    b = _tokens((ids[second] & (SECOND - 1)).astype(np.int64), doc[second], sides.b.widths)
    sizes = len(sides.a.tokens), len(sides.b.tokens)
    if len(ids):
        at, bt, with_b, with_a = links(a, b)
        groups = rendered(a, b, with_b, with_a, docs, sizes)
    else:
        at, bt, with_b = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        groups = pa.array([""] * docs, pa.string())
    area = sizes[0] * sizes[1]
    keys, times = np.unique(a.doc[at] * area + a.ids[at] * sizes[1] + b.ids[bt], return_counts=True)
    each = np.bincount(keys // area, minlength=docs)
    counts = (np.bincount(x, minlength=docs) for x in (a.doc, b.doc, a.doc[with_b], a.doc[at]))
    return [*(pa.array(c, pa.int64()) for c in counts), groups, _lists(keys % area, each, pa.int64()), _lists(times, each, pa.int32())]


def _parts(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Neighbours whose sizes add up to ``most`` at most, or one that is larger."""
    first, total = 0, 0
    for k, size in enumerate(sizes):
        if k > first and total + size > most:
            yield first, k
            first, total = k, 0
        total += size
    if sizes:
        yield first, len(sizes)


def align(documents: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its tokens of both sides, groups and links; ``pairs`` (first id times the second vocabulary's
    size plus second id) lists its different linked ids, rising, and ``times`` how often each is linked.

    Null and empty texts, and texts whose bytes a side doesn't give back, have no tokens: zeros and empty lists.
    Repeated rows, and rows without an id, are aligned like others; ``row`` tells them apart as long as
    the result is written before it is used twice. Other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, row = encoders(byte_path, piece_path), TaskContext.get().partitionId() << 40
        names = ["row", id_col, "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]
        for batch in (b.slice(at, DOCS) for b in batches for at in range(0, b.num_rows, DOCS)):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, last in _parts([len(t) for t in texts], ENCODED):
                coded = sides.encode(texts[first:last])
                for a, z in _parts([len(c) for c in coded], ALIGNED):
                    rows, ids = pa.array(np.arange(row, row + z - a), pa.int64()), batch.column(0).slice(first + a, z - a)
                    yield pa.RecordBatch.from_arrays([rows, ids, *_aligned(coded[a:z], sides)], names=names)
                    row += z - a
                pa.default_memory_pool().release_unused()

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text).mapInArrow(run, SCHEMA.format(id_col, kind))


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, n`` (the rows that hold it linked) and ``best``: no other pair of its first id is in more rows.

    A first id has at most ``size_b`` pairs, which bounds the groups.
    """
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = counts.withColumn("first", F.col("pair") - F.col("pair") % size_b)
    most = counts.groupBy("first").agg(F.max("n").alias("most"))
    return counts.join(most, "first").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def rated(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``aligned``, a written table, with ``count_sum`` (the counts of all links) and ``n_best`` (links of best pairs).

    The counts of the most frequent pairs, ``frequent`` of them at most, go to every task: 17 bytes for each. The
    others are joined, and are then rare in any input.
    """
    top = most_frequent(counts, "n", frequent).toArrow().sort_by("pair")
    keys, n, best = (top.column(c).to_numpy() for c in ("pair", "n", "best"))
    inputs, sums = aligned.select("row", "pairs", "times"), "row bigint, count_sum bigint, n_best bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            pairs, times = lists.flatten().to_numpy(), batch.column(2).flatten().to_numpy().astype(np.int64)
            each = np.diff(lists.offsets.to_numpy())
            doc = np.repeat(np.arange(len(each)), each)
            at = np.searchsorted(keys, pairs)
            known = np.zeros(len(pairs), bool)
            inside = at < len(keys)
            known[inside] = keys[at[inside]] == pairs[inside]
            at, of = at[known], times[known]
            left = np.bincount(doc[~known], minlength=len(each))
            total, of_best = (_sums(x, each - left) for x in (n[at] * of, best[at] * of))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(total, pa.int64()),
                    pa.array(of_best, pa.int64()),
                    _lists(pairs[~known], left, pa.int64()),
                    _lists(times[~known], left, pa.int64()),
                ],
                names=["row", "count_sum", "n_best", "pairs", "times"],
            )

    found = written(inputs.mapInArrow(run, f"{sums}, pairs array<bigint>, times array<bigint>"), "aligned-sums")
    rare = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", "l.pairs", "l.times")
    joined = rare.join(counts, F.col("pairs") == F.col("pair")).select(
        "row", (F.col("n") * F.col("times")).alias("count_sum"), F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best")
    )
    both = found.select("row", "count_sum", "n_best").unionByName(joined)
    totals = both.groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    return aligned.join(totals, "row")


def cross_alignment(
    documents: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row; see ``align``.

    The groups' own texts, some ten bytes for each token, are hashed where they are made and not stored.
    """
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=piece_path).vocab_size()
    found = align(documents, byte_path, piece_path, id_col, text)
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2(F.col("groups"), 256)).alias("groups_sha256")
    table = written(found.select(*(c for c in found.columns if c != "groups"), digest), "aligned", compression="zstd")
    counts = written(pair_counts(table, size_b), "pair-counts")
    rows = rated(table, counts, frequent)
    return rows.select(id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
