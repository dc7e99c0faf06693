"""Quality by a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover all of it. Learned filters run over each
chunk, one table row per place and byte, and are max-pooled; a hidden layer reads each chunk's maxima.
The chunks' hidden values are pooled by maximum and by mean, and combined into one probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS, WIDTH, HIDDEN = 16, 7, 12
#: Bytes of a chunk and of its step; chunks overlap by more than a filter's width.
CHUNK, STEP = 512, 480
PAD = 256  # a byte value that no text has
#: Documents that training draws at most, the chunks of each, from its first to its last, and the rounds. Scoring
#: has no such bound.
SAMPLE_DOCS, SAMPLE_CHUNKS, EPOCHS = 3_000, 16, 12
#: Chunks of a document in a training step, and documents of a step.
DRAWN, BATCH = 3, 32
#: Chunks whose filters run at a time.
BLOCK = 128
DOCS = 256


class Model(NamedTuple):
    """Tables of the filters (place, byte, filter), the layers above them, and the scale of the result."""

    tables: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def chunks(text: bytes) -> np.ndarray:
    """Rows of ``CHUNK + WIDTH - 1`` byte values that cover the text, padded at its end; one row where it is empty."""
    data = np.frombuffer(text, np.uint8)
    count = max(1, -(-max(0, len(data) - CHUNK) // STEP) + 1)
    padded = np.full((count - 1) * STEP + CHUNK + WIDTH - 1, PAD, np.int16)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK + WIDTH - 1)[::STEP]


def spread(rows: np.ndarray, most: int = SAMPLE_CHUNKS) -> np.ndarray:
    """At most so many chunks of a text, at even distances from the first to the last."""
    return rows if len(rows) <= most else rows[np.linspace(0, len(rows) - 1, most).round().astype(int)]


def _pooled(rows: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Largest value of each filter in each chunk, and where it is."""
    total = np.empty((len(rows), CHUNK, FILTERS), m.tables.dtype)
    step = np.empty_like(total)
    for place in range(WIDTH):
        np.take(m.tables[place], rows[:, place : place + CHUNK], axis=0, out=step if place else total, mode="clip")
        if place:
            total += step
    at = total.argmax(axis=1)
    return np.take_along_axis(total, at[:, None], axis=1)[:, 0] + m.bias, at


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def probability(text: bytes, m: Model) -> float:
    """Of label 1, from every chunk of the text."""
    rows = chunks(text)
    most, total = np.full(HIDDEN, -np.inf), np.zeros(HIDDEN)
    for at in range(0, len(rows), BLOCK):
        hidden = np.tanh(np.tanh(_pooled(rows[at : at + BLOCK], m)[0]) @ m.hidden + m.hidden_bias)
        most = np.maximum(most, hidden.max(axis=0))
        total += hidden.sum(axis=0)
    return float(_sigmoid(np.concatenate([most, total / len(rows)]) @ m.out + m.out_bias)[0])


def _initial(rng: np.random.Generator, share: float) -> Model:
    return Model(
        (rng.standard_normal((WIDTH, PAD + 1, FILTERS)) * 0.15).astype(np.float32),
        np.full(FILTERS, -0.5, np.float32),
        rng.standard_normal((FILTERS, HIDDEN)).astype(np.float32) / 3,
        np.zeros(HIDDEN, np.float32),
        (rng.standard_normal((2 * HIDDEN, 1)) / 5).astype(np.float32),
        np.array([math.log(share / (1 - share))], np.float32),
    )


def _gradients(rows: np.ndarray, doc: np.ndarray, y: np.ndarray, m: Model) -> list[np.ndarray]:
    """Of the mean log loss. ``doc`` numbers the document of each chunk, rising. Maxima pass on to their place alone."""
    n = len(y)
    raw, at = _pooled(rows, m)
    maxima = np.tanh(raw)
    hidden = np.tanh(maxima @ m.hidden + m.hidden_bias)
    first = np.searchsorted(doc, np.arange(n))
    size = np.bincount(doc, minlength=n)[:, None]
    most, mean = np.maximum.reduceat(hidden, first), np.add.reduceat(hidden, first) / size
    pooled = np.concatenate([most, mean], axis=1)
    error = ((_sigmoid(pooled @ m.out + m.out_bias)[:, 0] - y) / n)[:, None]
    d_out, d_pooled = pooled.T @ error, error @ m.out.T
    top = hidden == most[doc]
    d_hidden = d_pooled[doc, :HIDDEN] * top + (d_pooled[:, HIDDEN:] / size)[doc]
    d_hidden = d_hidden * (1 - hidden**2)
    d_raw = (d_hidden @ m.hidden.T) * (1 - maxima**2)
    d_tables = np.zeros_like(m.tables)
    chunk, kind = np.arange(len(rows))[:, None], np.arange(FILTERS)[None, :]
    for place in range(WIDTH):
        np.add.at(d_tables[place], (rows[chunk, at + place], kind), d_raw)
    return [d_tables, d_raw.sum(0), maxima.T @ d_hidden, d_hidden.sum(0), d_out, error.sum(0)]


def train(texts: Sequence[bytes], labels: Sequence[int], seed: int = 0) -> Model:
    return train_chunks([spread(chunks(t)) for t in texts], labels, seed)


def train_chunks(cut: Sequence[np.ndarray], labels: Sequence[int], seed: int = 0) -> Model:
    """Trains by Adam steps over random chunks of each document. Without both labels the score is their share."""
    y = np.asarray(labels, np.float32)
    rng = np.random.default_rng(seed)
    model = list(_initial(rng, float((y.sum() + 0.5) / (len(y) + 1))))
    if len(set(y.tolist())) < 2:
        model[4] = np.zeros_like(model[4])
        return Model(*model)
    first, second = ([np.zeros(p.shape, np.float32) for p in model] for _ in range(2))
    steps = EPOCHS * -(-len(y) // BATCH)
    count = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            drawn = [cut[i][rng.permutation(len(cut[i]))[:DRAWN]] for i in docs]
            doc = np.repeat(np.arange(len(docs)), [len(d) for d in drawn])
            grads = _gradients(np.concatenate(drawn), doc, y[docs], Model(*model))
            count += 1
            rate = 0.02 * (1 - count / (steps + 1)) * min(1, count / 20)
            for k, g in enumerate(grads):
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                up = first[k] / (1 - 0.9**count)
                model[k] = model[k] - rate * up / (np.sqrt(second[k] / (1 - 0.99**count)) + 1e-8)
    return Model(*(p.astype(np.float32) for p in model))


def train_on(
    documents: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text", label: str = "quality"
) -> Model:
    """Trains on at most ``SAMPLE_DOCS`` labelled documents for which ``usable`` (of the id) holds, by a hash of the id.

    Tasks cut the whole texts; the driver gets ``SAMPLE_CHUNKS`` chunks of each at most.
    """
    known = labels.where(F.col(label).isin(0, 1) & usable).groupBy(id_col).agg(F.max(label).cast("int").alias("y"))
    order = F.xxhash64(id_col)
    chosen = F.broadcast(known.orderBy(order, id_col).limit(SAMPLE_DOCS))  # at most SAMPLE_DOCS rows
    texts = documents.select(id_col, F.coalesce(text, F.lit("")).alias("t")).join(chosen, id_col)
    # of several texts with one id always the same
    one = texts.groupBy(id_col).agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("s"), F.max("y").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [spread(chunks(t)).tobytes() for t in batch.column(0).cast(pa.binary()).to_pylist()]
            columns = [pa.array(data, pa.binary()), batch.column(1), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=["chunks", "y", "h"])

    drawn = one.select("s.t", "y", order.alias("h")).mapInArrow(run, "chunks binary, y int, h bigint").collect()
    drawn.sort(key=lambda r: (r["h"], r["chunks"]))
    width = CHUNK + WIDTH - 1
    return train_chunks([np.frombuffer(r["chunks"], np.int16).reshape(-1, width) for r in drawn], [r["y"] for r in drawn])


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, score`` (0 to 1) for each row, from every byte of the whole text.

    A null text counts as empty, which is one chunk of padding. Rows without an id and repeated rows are
    scored like others. Only the two columns are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS):
                rows = batch.slice(first, DOCS)
                scores = [probability(t or b"", model) for t in rows.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(scores, pa.float64())], names=[id_col, "score"])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, score double")
