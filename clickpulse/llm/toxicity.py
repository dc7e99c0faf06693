"""Toxicity by compression distance: windows are compressed with an ordinary and a toxic dictionary.

Both dictionaries are made from labelled text. The ordinary one is trained by zstandard on windows of
documents without the label. The toxic one is those contents with the characteristic strings of toxic
documents put before them: parts of words that stand in many places there and rarely elsewhere. A window
that gets shorter with the second has a gain; gains over calibrated thresholds make a document's score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a window and of its step, and bytes from which a single word is cut.
WINDOW, STEP, LONGEST_WORD = 4, 3, 64
ORDINARY_BYTES, TOXIC_BYTES = 65_536, 2_048
#: Lengths and number of the characteristic strings that the toxic dictionary gets.
SUBSTRINGS, STRINGS = range(4, 11), 40
#: Documents that training draws at most, the characters of each in pieces at even distances from its first to its last
#: one, and the windows of each, drawn alike, that the ordinary dictionary is trained on. Scoring has no such bound.
SAMPLE_DOCS, SAMPLE_CHARS, PIECES, SAMPLE_WINDOWS = 4_000, 8_000, 16, 80
THRESHOLDS = (1, 2, 3, 4, 6)
DOCS = 256


class Model(NamedTuple):
    """Two dictionaries and the calibration: weights of a document's features, and the bias."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    bias: float


def windows(text: str | None) -> Iterator[bytes]:
    """Overlapping windows of words that cover the whole text, lower-cased; none for a text without words."""
    words = (text or "").lower().encode().split()
    if any(len(w) > LONGEST_WORD for w in words):
        words = [w[i : i + LONGEST_WORD] for w in words for i in range(0, len(w), LONGEST_WORD)]
    for at in range(0, max(1, len(words) - WINDOW + STEP) if words else 0, STEP):
        yield b" " + b" ".join(words[at : at + WINDOW])


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Short frames without headers; a search deep enough that a match in the dictionary is not missed."""
    settings = zstandard.ZstdCompressionParameters(
        compression_level=3, window_log=17, chain_log=16, hash_log=16, search_log=6, min_match=4, target_length=64,
        strategy=zstandard.STRATEGY_BTLAZY2, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    data = zstandard.ZstdCompressionDict(content)
    data.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=settings)


class Gains:
    """Bytes that the toxic dictionary saves on each window of a text."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self._plain, self._toxic = compressor(ordinary), compressor(ordinary[: len(ordinary) // 2] + toxic + ordinary[len(ordinary) // 2 :])

    def features(self, text: str | None) -> list[float]:
        """Largest gain, and for each threshold the windows that reach it: their logarithm and their share."""
        plain, toxic = self._plain.compress, self._toxic.compress
        most, count, over = 0, 0, Counter()
        for window in windows(text):
            gain = len(plain(window)) - len(toxic(window))
            count += 1
            if gain > 0:
                most = max(most, gain)
                over[gain] += 1
        high = [sum(n for g, n in over.items() if g >= t) for t in THRESHOLDS]
        return [min(most, 12) / 4, *(math.log1p(n) for n in high), *(20 * n / (count + 10) for n in high)]


def _places(texts: Sequence[str]) -> set[tuple[str, str, str]]:
    """Words with their neighbours, each place once: copies share their places and count once."""
    seen = set()
    for text in texts:
        words = re.findall(r"[^\W\d_]{4,}", text.lower())
        seen.update(zip(["", *words[:-1]], words, [*words[1:], ""]))
    return seen


def _substrings(word: str) -> set[str]:
    word = " " + word
    return {word[i : i + n] for n in SUBSTRINGS for i in range(len(word) - n + 1)}


def characteristic(toxic: Sequence[str], ordinary: Sequence[str], most: int = STRINGS) -> list[str]:
    """Parts of words that stand in many places of toxic documents and at a far lower rate elsewhere, best last."""
    there, elsewhere = _places(toxic), _places(ordinary)
    inside: Counter = Counter()
    for word, n in Counter(w for _, w, _ in there).items():
        for part in _substrings(word):
            inside[part] += n
    least = max(3, len(toxic) // 50)
    inside = Counter({part: n for part, n in inside.items() if n >= least})
    outside: Counter = Counter()
    for word, n in Counter(w for _, w, _ in elsewhere).items():
        for part in _substrings(word):
            if part in inside:
                outside[part] += n
    share = (len(elsewhere) + 1) / (len(there) + 1)
    excess = {p: n * math.log(n * share / (outside[p] + 1)) for p, n in inside.items() if n * share > 3 * (outside[p] + 1)}
    chosen: list[str] = []
    for part in sorted(excess, key=lambda p: (-excess[p] * len(p), p)):
        if not any(part in c or c in part for c in chosen):
            chosen.append(part)
            if len(chosen) == most:
                break
    return chosen[::-1]


def _spread(found: list[bytes], most: int) -> list[bytes]:
    """At most so many, at even distances from the first to the last."""
    return found if len(found) <= most else [found[round(k * (len(found) - 1) / (most - 1))] for k in range(most)]


def drawn(text: str) -> Column:
    """A whole text of ``SAMPLE_CHARS`` characters at most, else ``PIECES`` pieces with as many, from the first to the last."""
    size = SAMPLE_CHARS // PIECES
    spare = F.char_length(text) - size
    starts = [F.floor(spare * k / (PIECES - 1)).cast("int") + 1 for k in range(PIECES)]
    pieces = F.concat_ws(" ", *(F.substr(F.col(text), start, F.lit(size)) for start in starts))
    return F.when(F.char_length(text) <= SAMPLE_CHARS, F.col(text)).otherwise(pieces)


def train_dictionaries(texts: Sequence[str], labels: Sequence[int]) -> tuple[bytes, bytes]:
    toxic = [t for t, y in zip(texts, labels) if y == 1]
    ordinary = [t for t, y in zip(texts, labels) if y == 0]
    parts = [p.encode() for p in characteristic(toxic, ordinary)]
    content = b"".join(b" " + p.lstrip() for p in parts) or b"".join(w for t in toxic for w in windows(t))
    seen = {w: None for t in ordinary for w in _spread(list(windows(t)), SAMPLE_WINDOWS)}  # copies once, in order
    samples = [w for w in seen if not any(p in w for p in parts)]
    try:
        plain = zstandard.train_dictionary(ORDINARY_BYTES, samples, k=64, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text is the dictionary
        plain = b"".join(samples)[-ORDINARY_BYTES:]
    return plain, content[-TOXIC_BYTES:]


def _fit(x: np.ndarray, y: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Logistic regression of rows with these weights, with a small ridge, by Newton steps. The last weight is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), np.diag([0.3] * (x.shape[1] - 1) + [1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        bend = (x * (mass * (p * (1 - p) + 1e-9))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, x.T @ (mass * (p - y)) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(texts: Sequence[str], labels: Sequence[int], ones: float | None = None) -> Model:
    """Dictionaries from two thirds of the documents, calibration on the others, which they haven't seen.

    ``ones`` is the share of label 1 where it differs from the sample's: rows are weighted to it. Without both
    labels among the documents the score is the share of label 1, for every text.
    """
    labels = np.asarray(labels, dtype=float)
    third = np.arange(len(texts)) % 3 == 0
    share = (labels.sum() + 0.5) / (len(labels) + 1) if ones is None else ones
    if len(set(labels[third])) < 2 or len(set(labels[~third])) < 2:
        return Model(b"", b"", (), math.log(share / (1 - share)))
    fit = np.flatnonzero(~third)
    ordinary, toxic = train_dictionaries([texts[i] for i in fit], labels[fit])
    gains = Gains(ordinary, toxic)
    held = np.flatnonzero(third)
    mean = labels[held].mean()
    mass = np.where(labels[held] == 1, share / mean, (1 - share) / (1 - mean))
    weights = _fit(np.array([gains.features(texts[i]) for i in held]), labels[held], mass)
    return Model(ordinary, toxic, tuple(weights[:-1]), float(weights[-1]))


def train_on(
    documents: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model:
    """Trains on at most ``SAMPLE_DOCS`` labelled documents for which ``usable`` (of the id) holds.

    Each label gets up to half of the bound, by a hash of the id; the calibration gives them back their
    true shares. Training sees ``SAMPLE_CHARS`` characters of a document, from all over it.
    """
    known = labels.where(F.col(label).isin(0, 1) & usable).groupBy(id_col).agg(F.max(label).alias("y"))
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(id_col)
    halves = [known.where(F.col("y") == y).orderBy(order, id_col).limit(SAMPLE_DOCS // 2) for y in (0, 1)]
    chosen = F.broadcast(halves[0].unionByName(halves[1]))  # at most SAMPLE_DOCS rows
    texts = documents.select(id_col, F.coalesce(drawn(text), F.lit("")).alias("t")).join(chosen, id_col)
    # of several texts with one id always the same
    one = texts.groupBy(id_col).agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("s"), F.max("y").alias("y"))
    rows = one.orderBy(order, id_col).select("s.t", "y").collect()
    ones = total.get(1, 0) / max(1, sum(total.values()))
    return train([r["t"] for r in rows], [r["y"] for r in rows], ones or None)


def _raw_scores(texts: Sequence[str | None], model: Model, gains: Gains | None) -> np.ndarray:
    raw = [model.bias + (sum(a * b for a, b in zip(model.weights, gains.features(t))) if gains else 0.0) for t in texts]
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _scored(batches: Iterator[pa.RecordBatch], model: Model, text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    gains = Gains(model.ordinary, model.toxic) if model.weights else None
    for batch in batches:
        for first in range(0, batch.num_rows, DOCS):
            rows = batch.slice(first, DOCS)
            texts = rows.column(rows.schema.get_field_index(text)).to_pylist()
            yield rows, _raw_scores(texts, model, gains)


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, score`` (0 to 1) for each row, from every window of the whole text.

    A null text counts as empty; an empty one has no windows and gets the score of no gain. Rows
    without an id and repeated rows are scored like others. Only the two columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, scores in _scored(batches, model, text):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores)], names=[id_col, "score"])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, score double")


def accept(documents: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents``, all columns as they are, whose score is below ``threshold``. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, scores in _scored(batches, model, text):
            yield rows.filter(pa.array(scores < threshold))

    return documents.mapInArrow(run, documents.schema)
