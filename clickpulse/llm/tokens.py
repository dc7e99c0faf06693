"""Texts to token ids inside tasks: exact pieces, each different one encoded once."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: From different keys to their ids, one after the other, and how many each has.
Encode = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]

_PIECE = re.compile(r"\s*\S+|\s+")
#: White space to Python but not to the tokenizers: a text that holds one is a piece of its own.
_ODD = re.compile("[\x1c-\x1f]")
#: White space other than a space and a line break.
_OTHER = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_DOUBLE = ("  ", "\n\n", " \n", "\n ")
#: A word of Latin letters and the signs behind it.
_SIGNS = r"^(?P<word>\n?[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<signs>[!-@\[-`{-~](?s:.*))$"
_RAW = "\r"
#: Pieces remembered, the most bytes of one, and the bytes of all from which longer ones go. They bound a task's
#: memory, not what is encoded.
REMEMBERED, LONGEST, BYTES = 1_500_000, 64, 1 << 27
#: Pieces and characters that are cut at a time.
STEP, CHARS = 200_000, 3_000_000
#: Pieces that the library gets as one text.
TOGETHER = 10_000


def plain(text: str) -> bool:
    """Whether the white space of a text is single spaces and line breaks between other characters."""
    if not text or text[0].isspace() or text[-1].isspace():
        return False
    return not any(two in text for two in _DOUBLE) and not any(c in text for c in _OTHER)


class Words(NamedTuple):
    """The words of plain texts: the different ones, the number of each word in turn, and where each text's begin.

    A word is the key of its piece: without the space before it, or with the line break before it.
    """

    different: pa.Array
    codes: np.ndarray
    offsets: np.ndarray


def words_of(texts: list[str]) -> Words:
    lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " \n"), " ")
    coded = lists.flatten().dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy(), lists.offsets.to_numpy())


def as_key(piece: str) -> str:
    """The key of any piece; ``_RAW`` is in no plain text."""
    return _RAW + piece


def piece_of(key: str) -> str:
    return key[1:] if key[:1] == _RAW else key if key[:1] == "\n" else " " + key


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that ``codes`` name, one after the other, and where each ends."""
    each = sizes[codes]
    ends = np.cumsum(each)
    shifts = starts[codes] - (ends - each)
    if max(len(flat), int(ends[-1]) if len(ends) else 0) < 1 << 31:  # half the memory
        shifts = shifts.astype(np.int32)
    at = np.repeat(shifts, each)
    at += np.arange(len(at), dtype=at.dtype)
    return flat[at], ends


class Store:
    """Ids of the keys met lately, in flat arrays. ``encode`` gives the ids of new ones, and how many each has."""

    def __init__(self, encode: Encode, size: int | None = None) -> None:
        self._encode, self._size = encode, size
        self._keys, self._used, self._now = pa.array([], pa.string()), np.zeros(0, np.int64), 0
        self.ids, self.starts, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def places(self, keys: pa.Array) -> np.ndarray:
        """The entry of each of different keys; they hold until ``trim``."""
        self._now += 1
        at = pc.index_in(keys, value_set=self._keys).fill_null(-1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            at[missing] = len(self._keys) + np.arange(len(missing))
            fresh = keys.take(pa.array(missing))
            ids, sizes = self._encode(fresh)
            self._keys = pa.concat_arrays([self._keys, fresh])
            self._used = np.concatenate([self._used, np.zeros(len(missing), np.int64)])
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        self._used[at] = self._now
        return at

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gathered(self.ids, self.starts, self.sizes, codes)

    def trim(self) -> None:
        """Forgets long pieces when there is too much, and when there are too many others, all but those used last."""
        most = self._size or REMEMBERED
        if len(self._keys) <= most and self._keys.nbytes <= BYTES:
            return
        keep = np.flatnonzero(pc.binary_length(self._keys).to_numpy() <= LONGEST)
        if len(keep) > most:
            keep = np.sort(keep[np.argsort(-self._used[keep], kind="stable")[: most // 2]])
        self.ids, ends = self.gather(keep)
        self._keys, self._used, self.sizes = self._keys.take(pa.array(keep)), self._used[keep], self.sizes[keep]
        self.starts = ends - self.sizes


class PieceEncoder:
    """Encodes texts piece by piece with ``encode``, and remembers the pieces it has met.

    Pieces start where a non-space is followed by white space. The splitting pattern of the byte-level
    vocabularies never matches across such a place and never looks behind it, so the pieces' ids
    joined are the text's ids. Nor does it match from a Latin letter to a sign behind it, so in plain texts
    words and the signs behind them are pieces of their own.
    """

    def __init__(self, encode: Encode) -> None:
        self.store = Store(encode)

    def _even(self, texts: list[str]) -> Iterator[bytes]:
        words, store = words_of(texts), self.store
        starts = words.offsets[:-1]
        cut = pc.extract_regex(words.different, _SIGNS)
        signs = pc.fill_null(cut.field("signs").filter(cut.is_valid()), "")
        heads = pc.if_else(cut.is_valid(), cut.field("word"), words.different)
        firsts = heads.take(pa.array(words.codes[starts]))  # no white space is before them
        keys = pa.concat_arrays([heads, pc.binary_join_element_wise(_RAW, firsts, ""), pc.binary_join_element_wise(_RAW, signs, "")])
        keys = keys.dictionary_encode()
        at = store.places(keys.dictionary)[keys.indices.to_numpy()]
        # each word is two entries, of which the second may be empty: the last place is that of no signs
        store_starts, store_sizes = np.append(store.starts, 0), np.append(store.sizes, 0)
        tail = np.full(len(heads), len(store.sizes))
        tail[cut.is_valid().to_numpy(zero_copy_only=False)] = at[len(heads) + len(firsts) :]
        codes = np.empty((len(words.codes), 2), np.int64)
        codes[:, 0], codes[:, 1] = at[words.codes], tail[words.codes]
        codes[starts, 0] = at[len(heads) : len(heads) + len(firsts)]
        ids, ends = gathered(store.ids, store_starts, store_sizes, codes.ravel())
        store.trim()
        data, cuts = ids.tobytes(), [0, *(4 * ends[2 * words.offsets[1:].astype(np.int64) - 1]).tolist()]
        return (data[a:z] for a, z in zip(cuts, cuts[1:]))

    def _uneven(self, text: str) -> bytes:
        if not text:
            return b""
        pieces = iter([text]) if _ODD.search(text) else (m[0] for m in _PIECE.finditer(text))
        return b"".join(map(self._ids, iter(lambda: list(islice(pieces, STEP)), [])))

    def _ids(self, pieces: list[str]) -> bytes:
        keys = pa.array([as_key(p) for p in pieces], pa.string()).dictionary_encode()
        ids = self.store.gather(self.store.places(keys.dictionary)[keys.indices.to_numpy()])[0].tobytes()
        self.store.trim()
        return ids

    def _joined(self, texts: list[str]) -> Iterator[bytes]:
        even = [plain(t) for t in texts]
        of_even = self._even([t for t, p in zip(texts, even) if p]) if any(even) else iter(())
        return (next(of_even) if p else self._uneven(t) for t, p in zip(texts, even))

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers, in order; null is empty."""
        waiting, chars = [], 0
        for text in texts:
            text = text or ""
            if len(text) > CHARS:
                yield from self._joined(waiting)
                waiting, chars = [], 0
                yield self._uneven(text)
                continue
            waiting.append(text)
            chars += len(text)
            if chars >= CHARS:
                yield from self._joined(waiting)
                waiting, chars = [], 0
        yield from self._joined(waiting)


def library_encode(path: str, specials: bool) -> Encode:
    """Encodes keys with the ``tokenizers`` library.

    With ``specials``, the library's default, a special token's string in a text is that token; without,
    it is ordinary text. Such strings hold no white space and don't begin with a letter.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = not specials
    # the vocabulary writes each byte as one character
    widths = np.zeros(model.get_vocab_size(), np.int64)
    for token, number in model.get_vocab().items():
        widths[number] = len(token)

    def ids_of(text: str) -> list[int]:
        return model.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def joined(keys: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words' pieces, which begin with white space and end without it, encoded as one text and cut again."""
        text = "".join(map(piece_of, keys))
        ids = np.array(ids_of(text), "<u4")
        places = np.searchsorted(np.cumsum(widths[ids]), np.cumsum(lengths)) + 1
        return ids, np.diff(places, prepend=0)

    def encode(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw = pc.starts_with(keys, _RAW).to_numpy(zero_copy_only=False)
        sizes, found, order = np.zeros(len(keys), np.int64), [], np.concatenate([np.flatnonzero(~raw), np.flatnonzero(raw)])
        words = keys.filter(pa.array(~raw))
        own = pc.starts_with(words, "\n").to_numpy(zero_copy_only=False)
        lengths, whole = pc.binary_length(words).to_numpy() + 1 - own, words.to_pylist()
        counts = []
        for at in range(0, len(whole), TOGETHER):
            ids, each = joined(whole[at : at + TOGETHER], lengths[at : at + TOGETHER])
            found.append(ids)
            counts.append(each)
        for key in keys.filter(pa.array(raw)).to_pylist():
            ids = np.array(ids_of(piece_of(key)), "<u4")
            found.append(ids)
            counts.append([len(ids)])
        sizes[order] = np.concatenate(counts)
        flat = np.concatenate(found)
        if raw.any() and not raw.all():  # back to the keys' order
            starts = np.zeros(len(keys), np.int64)
            starts[order] = np.cumsum(sizes[order]) - sizes[order]
            flat = gathered(flat, starts, sizes, np.arange(len(keys)))[0]
        return flat, sizes

    return encode


@lru_cache(maxsize=2)  # a Python worker's tasks share what has been learnt
def library_encoder(path: str) -> PieceEncoder:
    """Gives the ids of the ``tokenizers`` library, special tokens' strings in a text included."""
    return PieceEncoder(library_encode(path, specials=True))


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
