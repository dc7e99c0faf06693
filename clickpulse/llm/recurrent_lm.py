"""Log-probabilities of whole texts under a gated recurrent language model in numpy.

Counts of all words come from Spark. The most frequent training words are symbols of their own, all
others fall into bands by frequency, and a word's share of its band is its counted one; so every word has
a probability and all of them add up to one. The output is factored: the class of a symbol, then the symbol
in its class. Training is truncated backpropagation: tasks run over their documents side by side in lanes,
the state goes from window to window and starts anew at each document, and Spark averages what the tasks
have learnt. Scoring carries the state through every document from its first word to its end.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from clickpulse.llm.shared import most_frequent, written

#: Words that every task knows by number, and the most bytes of one. The counts of all others are joined.
DICTIONARY, WORD_BYTES = 200_000, 64
#: Words that are symbols of their own, the end included, and bands of the others.
SYMBOLS, BANDS = 1_024, 8
CLASSES, HIDDEN = 32, 16
#: Documents side by side and steps of a window, in training and in scoring.
TRAIN_LANES, TRAIN_WINDOW, LANES, WINDOW = 256, 32, 512, 32
#: The starting point: documents drawn for it at most, the tokens in a row of each, wherever they are in it, and its
#: updates. After it every training document is learnt from once.
START_DOCS, START_TOKENS, START_UPDATES = 1_000, 1_000, 300
#: Parts of the training documents, by a hash, after each of which the tasks' parameters are averaged.
ROUNDS = 2
#: Tasks that train at most, and parameter sets averaged in one group.
TRAINERS, AVERAGED = 4_096, 64
#: Tokens arranged in lanes at a time; a longer document is a batch of its own.
TOKENS = 2_000_000
#: Documents counted, and coded, at a time.
DOCS = 2_048
#: Of the first round; each later one takes a third of it.
RATE = 0.008
#: The largest logit, either way.
LOGIT = np.float32(30)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different lower-case words, the number of each word in turn, and how many each text has; null has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, each = lists.flatten(), np.diff(lists.offsets.to_numpy())
    there = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not there.all():  # white space at an end
        text = np.repeat(np.arange(len(each)), each)[there]
        flat, each = flat.filter(pa.array(there)), np.bincount(text, minlength=len(each))
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), each


def word_counts(documents: DataFrame, text: str, held_out: Column) -> DataFrame:
    """``word, c`` (occurrences in training texts) and ``n`` (in all). Each batch is counted before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(first, 2 * DOCS) for b in batches for first in range(0, b.num_rows, 2 * DOCS)):
            words, codes, each = words_of(batch.column(0))
            train = np.repeat(~batch.column(1).to_numpy(zero_copy_only=False), each)
            counts = (np.bincount(x, minlength=len(words)) for x in (codes[train], codes))
            yield pa.RecordBatch.from_arrays([words, *(pa.array(c, pa.int64()) for c in counts)], names=["word", "c", "n"])
            pa.default_memory_pool().release_unused()

    rows = documents.select(text, held_out.alias("held_out"))
    counted = rows.mapInArrow(run, "word string, c bigint, n bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


class Lexicon(NamedTuple):
    """What every task knows of the words.

    Code ``len(words)`` stands for all other words and the next one for the end. ``symbol`` and ``inner`` (the
    log10 share of its band, 0 for a symbol of its own) are by code, ``counts`` are training counts by code.
    Symbols are numbered by falling frequency and cut into classes at ``cuts``.
    """

    words: pa.Array
    counts: np.ndarray
    symbol: np.ndarray
    inner: np.ndarray
    cuts: np.ndarray
    end: int


def lexicon(words: list[str], counts: np.ndarray, ends: int, total: int, different: int, symbols: int = SYMBOLS) -> Lexicon:
    """``ends``, ``total`` and ``different`` count the training texts, their tokens and different tokens, ends included.

    Words beyond ``words`` share the last band with all unseen ones, which count as one more.
    """
    size = len(words)
    order = np.lexsort((np.arange(size), -counts))
    order = order[counts[order] > 0]
    own, banded = order[: symbols - 1], order[symbols - 1 :]
    mass = np.concatenate([[0], np.cumsum(counts[banded])])
    band = np.minimum((BANDS - 1) * mass[:-1] // max(1, mass[-1]), BANDS - 2) if len(banded) else np.zeros(0, np.int64)
    kind = np.full(size + 2, len(own) + BANDS)  # the last band
    kind[own], kind[banded], kind[size + 1] = np.arange(len(own)) + 1, len(own) + 1 + band, 0
    weight = np.zeros(len(own) + 1 + BANDS)
    weight[0] = ends
    np.add.at(weight, kind[order], counts[order])
    in_band = np.bincount(kind[banded], minlength=len(weight))
    last_n, last_v = total - weight[:-1].sum(), different - (ends > 0) - len(own) - len(banded)
    weight[-1], in_band[-1] = last_n, last_v + 1
    inner = np.zeros(size + 2)
    outside = kind > len(own)
    share = np.append(counts, [0, ends])
    inner[outside] = np.log10(share[outside] + 1) - np.log10(np.maximum(1, weight + in_band)[kind[outside]])
    rank = np.empty(len(weight), np.int64)
    rank[np.argsort(-weight, kind="stable")] = np.arange(len(weight))
    roots = np.sqrt(np.sort(weight)[::-1] + 1)
    place = np.minimum(CLASSES * (np.cumsum(roots) - roots) // roots.sum(), CLASSES - 1)
    cuts = np.append(np.flatnonzero(np.append(True, place[1:] != place[:-1])), len(weight))
    return Lexicon(pa.array(words, pa.string()), share, rank[kind].astype(np.int32), inner, cuts, int(rank[0]))


class Net(NamedTuple):
    """Input table of the three gates, recurrent weights, and the two output layers with their biases.

    First axis: what comes out of a layer; for the input table and the words' layer the second is the symbol.
    """

    inputs: np.ndarray
    recurrent: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray
    word_bias: np.ndarray


def initial(symbols: int, classes: int, hidden: int = HIDDEN, seed: int = 0) -> Net:
    rng = np.random.default_rng(seed)

    def some(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.1).astype(np.float32)

    return Net(
        some(3 * hidden, symbols),
        some(3 * hidden, hidden) * 3,
        some(classes, hidden),
        np.zeros((classes, 1), np.float32),
        some(symbols, hidden),
        np.zeros((symbols, 1), np.float32),
    )


class Lanes(NamedTuple):
    """Documents end to end in lanes, longest lane first: symbols (-1 behind a lane's end), where documents begin,
    the number of each document's first place over all lanes, and the document there."""

    symbols: np.ndarray
    begins: np.ndarray
    places: np.ndarray
    docs: np.ndarray


def arranged(symbols: np.ndarray, sizes: np.ndarray, most: int) -> Lanes:
    """The longest document goes to the shortest lane each time."""
    ends = np.cumsum(sizes)
    heap = [(0, k) for k in range(min(most, len(sizes)))]
    dealt: list[list[int]] = [[] for _ in heap]
    for doc in np.argsort(-sizes, kind="stable").tolist():
        length, lane = heap[0]
        dealt[lane].append(doc)
        heapq.heapreplace(heap, (length + int(sizes[doc]), lane))
    lengths = dict((lane, length) for length, lane in heap)
    lanes = sorted(range(len(dealt)), key=lambda k: -lengths[k])
    steps = max(lengths.values(), default=0)
    out, begins = np.full((len(lanes), steps), -1, np.int32), np.zeros((len(lanes), steps), bool)
    places, docs = [], []
    for row, lane in enumerate(lanes):
        at = 0
        for doc in dealt[lane]:
            size = int(sizes[doc])
            out[row, at : at + size] = symbols[ends[doc] - size : ends[doc]]
            begins[row, at] = True
            places.append(row * steps + at)
            docs.append(doc)
            at += size
    return Lanes(out, begins, np.array(places, np.int64), np.array(docs, np.int64))


class Steps(NamedTuple):
    """What a window's steps leave for the way back: first axis the unit, then steps, then lanes."""

    before: np.ndarray
    z: np.ndarray
    r: np.ndarray
    q: np.ndarray
    n: np.ndarray
    after: np.ndarray


def forward(net: Net, inputs: np.ndarray, keep: np.ndarray, state: np.ndarray) -> Steps:
    """``keep`` is 0 where a document begins, so the state starts anew."""
    hidden = net.recurrent.shape[1]
    given = np.take(net.inputs, inputs, axis=1)
    before, z, r, q, n, after = (np.empty((hidden, *inputs.shape), given.dtype) for _ in range(6))
    for t in range(len(inputs)):
        own = state * keep[t]
        mixed = net.recurrent @ own
        gates = given[: 2 * hidden, t] + mixed[: 2 * hidden]
        gates *= 0.5  # the logistic function by the hyperbolic tangent
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        before[:, t], z[:, t], r[:, t], q[:, t] = own, gates[:hidden], gates[hidden:], mixed[2 * hidden :]
        new = gates[hidden:] * mixed[2 * hidden :]
        new += given[2 * hidden :, t]
        np.tanh(new, out=new)
        own -= new
        own *= gates[:hidden]
        own += new
        n[:, t], after[:, t], state = new, own, own
    return Steps(before, z, r, q, n, after)


def _softmax(logits: np.ndarray) -> np.ndarray:
    """In place: probabilities down the first axis. Logits end at ``LOGIT``."""
    np.clip(logits, -LOGIT, LOGIT, out=logits)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def output(net: Net, cuts: np.ndarray, states: np.ndarray, targets: np.ndarray, gradients: list[np.ndarray] | None = None):
    """Natural log-probability of each target; with ``gradients`` also adds those of the mean loss, and gives the states'."""
    number = np.repeat(np.arange(len(cuts) - 1, dtype=np.int16), np.diff(cuts))[targets]
    columns = np.arange(len(targets))
    p = _softmax(net.classes @ states + net.class_bias)
    found = np.log(p[number, columns])
    order = np.argsort(number, kind="stable")
    edges = np.searchsorted(number[order], np.arange(len(cuts)))
    sorted_states, sorted_targets = np.take(states, order, axis=1), targets[order]
    inside = np.zeros(len(targets), states.dtype)
    back = np.zeros_like(states) if gradients is not None else None
    for k in range(len(cuts) - 1):
        a, z, first, last = edges[k], edges[k + 1], cuts[k], cuts[k + 1]
        if a == z or last - first == 1:
            continue
        own, place, at = sorted_states[:, a:z], sorted_targets[a:z] - first, columns[: z - a]
        share = _softmax(net.words[first:last] @ own + net.word_bias[first:last])
        inside[a:z] = np.log(share[place, at])
        if gradients is not None:
            share[place, at] -= 1
            gradients[4][first:last] += share @ own.T
            gradients[5][first:last] += share.sum(axis=1, keepdims=True)
            back[:, a:z] = net.words[first:last].T @ share
    found[order] += inside
    if gradients is None:
        return found, None
    p[number, columns] -= 1
    gradients[2] += p @ states.T
    gradients[3] += p.sum(axis=1, keepdims=True)
    out = net.classes.T @ p
    out[:, order] += back
    for g in gradients[2:]:
        g /= len(targets)
    out /= len(targets)
    return found, out


def backward(net: Net, s: Steps, inputs: np.ndarray, keep: np.ndarray, back: np.ndarray, gradients: list[np.ndarray]) -> None:
    """Adds the gradients of the recurrent part, from the window's last step to its first."""
    hidden, steps, lanes = back.shape
    of_input, of_mixed = (np.empty((3 * hidden, steps, lanes), back.dtype) for _ in range(2))
    # the slopes of all steps at once
    slope_z = (s.before - s.n) * s.z * (1 - s.z)
    slope_n = (1 - s.z) * (1 - s.n * s.n)
    slope_r = s.q * s.r * (1 - s.r)
    d = np.zeros((hidden, lanes), back.dtype)
    turned = np.ascontiguousarray(net.recurrent.T)
    for t in range(steps - 1, -1, -1):
        d += back[:, t]
        dn = d * slope_n[:, t]
        of_input[:hidden, t], of_input[hidden : 2 * hidden, t], of_input[2 * hidden :, t] = d * slope_z[:, t], dn * slope_r[:, t], dn
        of_mixed[: 2 * hidden, t], of_mixed[2 * hidden :, t] = of_input[: 2 * hidden, t], dn * s.r[:, t]
        d *= s.z[:, t]
        d += turned @ of_mixed[:, t]
        d *= keep[t]
    gradients[1] += of_mixed.reshape(3 * hidden, -1) @ s.before.reshape(hidden, -1).T
    flat = inputs.ravel()
    order = np.argsort(flat.astype(np.int16) if net.inputs.shape[1] < 1 << 15 else flat, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(flat[order]) != 0))
    rows = np.ascontiguousarray(of_input.reshape(3 * hidden, -1).T)[order]
    gradients[0][:, flat[order[starts]]] += np.add.reduceat(rows, starts, axis=0).T


def _windows(lanes: Lanes, end: int, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Inputs, targets (-1 where there is none) and kept states of each window (steps by lanes), and its first step."""
    count, steps = lanes.symbols.shape
    lengths = (lanes.symbols >= 0).sum(axis=1)
    for first in range(0, steps, window):
        live = int((lengths > first).sum())  # lanes are sorted
        targets = np.ascontiguousarray(lanes.symbols[:live, first : first + window].T)
        inputs = np.empty_like(targets)
        inputs[1:], inputs[0] = targets[:-1], lanes.symbols[:live, first - 1] if first else end
        begins = np.ascontiguousarray(lanes.begins[:live, first : first + window].T)
        yield np.where(begins, end, np.maximum(inputs, 0)), targets, 1 - begins.astype(np.float32), first


class Trainer:
    """Adam over windows; the rate falls with ``planned`` updates, or stays."""

    def __init__(self, net: Net, cuts: np.ndarray, end: int, rate: float, planned: int | None = None) -> None:
        self.net, self.cuts, self.end, self.rate, self.planned = net, cuts, end, rate, planned
        self._first, self._second = ([np.zeros_like(p) for p in net] for _ in range(2))
        self.updates, self.tokens = 0, 0

    def learn(self, symbols: np.ndarray, sizes: np.ndarray, most: int, window: int) -> None:
        """Runs through all documents, and takes the gradients of every window."""
        lanes = arranged(symbols, sizes, most)
        state = np.zeros((self.net.recurrent.shape[1], len(lanes.symbols)), np.float32)
        for inputs, targets, keep, _ in _windows(lanes, self.end, window):
            steps = forward(self.net, inputs, keep, state[:, : inputs.shape[1]])
            state = steps.after[:, -1]
            valid = targets >= 0
            self.tokens += int(valid.sum())
            gradients = [np.zeros_like(p) for p in self.net]
            _, out = output(self.net, self.cuts, steps.after[:, valid], targets[valid], gradients)
            back = np.zeros_like(steps.after)
            back[:, valid] = out
            backward(self.net, steps, inputs, keep, back, gradients)
            self._update(gradients)

    def _update(self, gradients: list[np.ndarray]) -> None:
        self.updates += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in gradients)))
        rate = self.rate * (max(0.1, 1 - self.updates / self.planned) if self.planned else 1) * min(1, self.updates / 20)
        moved = []
        for k, (p, g) in enumerate(zip(self.net, gradients)):
            if norm > 1:
                g /= norm
            self._first[k] += 0.1 * (g - self._first[k])
            self._second[k] += 0.01 * (g * g - self._second[k])
            up = self._first[k] / (1 - 0.9**self.updates)
            moved.append(p - np.float32(rate) * up / (np.sqrt(self._second[k] / (1 - 0.99**self.updates)) + np.float32(1e-6)))
        self.net = Net(*moved)


def log_probabilities(net: Net, cuts: np.ndarray, end: int, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural log-probability of each document's symbols, the state carried through the whole document."""
    lanes = arranged(symbols, sizes, LANES)
    found = np.zeros(lanes.symbols.shape, np.float32)
    state = np.zeros((net.recurrent.shape[1], len(lanes.symbols)), np.float32)
    for inputs, targets, keep, first in _windows(lanes, end, WINDOW):
        steps = forward(net, inputs, keep, state[:, : inputs.shape[1]])
        state = steps.after[:, -1]
        valid = targets >= 0
        part = np.zeros(targets.shape, np.float32)
        part[valid] = output(net, cuts, steps.after[:, valid], targets[valid])[0]
        found[: inputs.shape[1], first : first + len(part)] = part.T
    out = np.zeros(len(sizes))
    if len(sizes):
        out[lanes.docs] = np.add.reduceat(found.ravel(), lanes.places, dtype=np.float64)
    return out


def coded(documents: DataFrame, held_out: Column, known: Lexicon, id_col: str, text: str) -> DataFrame:
    """``row, id_col, held_out, n_tokens, codes`` (of each word in turn, then of the end) and, of the words that
    ``known`` has not, ``words`` and ``times``."""
    dictionary, size = known.words, len(known.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in (b.slice(first, DOCS) for b in batches for first in range(0, b.num_rows, DOCS)):
            words, codes, each = words_of(batch.column(1))
            place = pc.fill_null(pc.index_in(words, value_set=dictionary), size).to_numpy()
            numbers, text_of = place[codes], np.repeat(np.arange(len(each)), each)
            other = np.flatnonzero(numbers == size)
            pairs, times = np.unique(text_of[other] * max(1, len(words)) + codes[other], return_counts=True)
            with_end = np.insert(numbers, np.cumsum(each), size + 1).astype(np.int32)
            lists = np.bincount(pairs // max(1, len(words)), minlength=len(each))
            ends = pa.array(np.concatenate([[0], np.cumsum(each + 1)]), pa.int32())
            other_ends = pa.array(np.concatenate([[0], np.cumsum(lists)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + len(each)), pa.int64()),
                    batch.column(0),
                    batch.column(2),
                    pa.array(each + 1, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(with_end, pa.int32())),
                    pa.ListArray.from_arrays(other_ends, words.take(pa.array(pairs % max(1, len(words))))),
                    pa.ListArray.from_arrays(other_ends, pa.array(times, pa.int64())),
                ],
                names=["row", id_col, "held_out", "n_tokens", "codes", "words", "times"],
            )
            row += len(each)
            pa.default_memory_pool().release_unused()

    kind = documents.schema[id_col].dataType.simpleString()
    schema = f"row bigint, `{id_col}` {kind}, held_out boolean, n_tokens bigint, codes array<int>, words array<string>, times array<bigint>"
    return documents.select(id_col, text, held_out.alias("held_out")).mapInArrow(run, schema)


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbouring documents of ``TOKENS`` tokens at most, or a longer one."""
    first, total = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > first and total + size > TOKENS:
            yield first, k
            first, total = k, 0
        total += size
    if len(sizes):
        yield first, len(sizes)


def _documents(lists: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Codes and sizes of parts of a batch, with the first and last document's number."""
    offsets, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy()
    for a, z in _parts(np.diff(offsets)):
        yield a, z, flat[offsets[a] - offsets[0] : offsets[z] - offsets[0]], np.diff(offsets[a : z + 1]).astype(np.int64)


def started(table: DataFrame, known: Lexicon) -> Net:
    """The starting point, from a bounded sample of training documents taken by a hash of their row."""
    net = initial(int(known.cuts[-1]), len(known.cuts) - 1)
    spare = F.greatest(F.size("codes") - START_TOKENS, F.lit(0))
    some = F.slice("codes", F.pmod(F.xxhash64("row", F.lit(1)), spare + 1).cast("int") + 1, F.lit(START_TOKENS))
    rows = table.where("not held_out").select(some.alias("codes"), F.xxhash64("row").alias("h"), "row")
    found = [np.asarray(c, np.int64) for c in rows.orderBy("h", "row").limit(START_DOCS).toArrow().column("codes").to_pylist()]
    if not found:
        return net
    symbols, sizes = known.symbol[np.concatenate(found)], np.array([len(f) for f in found])
    trainer = Trainer(net, known.cuts, known.end, 3 * RATE, START_UPDATES)
    while trainer.updates < START_UPDATES:
        trainer.learn(symbols, sizes, 64, 16)
    return trainer.net


def averaged(rows: DataFrame) -> Row | None:
    """The mean of parameter sets (``part, weight, net``) by weight, in groups of ``AVERAGED`` sets at most."""

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        weight = float(frame["weight"].sum())
        total = reduce(np.add, (np.frombuffer(n, np.float32) * (w / weight) for n, w in zip(frame["net"], frame["weight"])))
        return pd.DataFrame({"part": [int(frame["part"].iloc[0])], "weight": [weight], "net": [total.astype(np.float32).tobytes()]})

    while rows.count() > 1:
        group = F.floor(F.col("part") / AVERAGED).cast("int")
        rows = written(rows.withColumn("part", group).groupBy("part").applyInPandas(mean, rows.schema), "lm-parameters")
    return rows.first()


def trained(table: DataFrame, known: Lexicon, rounds: int = ROUNDS) -> Net:
    """Learns from every training document of ``table`` once, a part of them in each round.

    Each task starts a round from the same parameters and learns from its own documents; the tasks' parameters
    are averaged by the tokens they have seen. At most ``TRAINERS`` tasks train.
    """
    net = started(table, known)
    shapes, symbol, cuts, end = [p.shape for p in net], known.symbol, known.cuts, known.end
    for k in range(rounds):
        start, rate = net, RATE / 3**k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(start, cuts, end, rate)  # noqa: B023
            for batch in batches:
                for _, _, codes, sizes in _documents(batch.column(0)):
                    trainer.learn(symbol[codes], sizes, TRAIN_LANES, TRAIN_WINDOW)
            if trainer.tokens:
                flat = np.concatenate([p.ravel() for p in trainer.net]).astype(np.float32).tobytes()
                part = TaskContext.get().partitionId()
                columns = [pa.array([part], pa.int32()), pa.array([float(trainer.tokens)]), pa.array([flat], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "weight", "net"])

        own = table.where(~F.col("held_out") & (F.pmod(F.xxhash64("row"), F.lit(rounds)) == k)).select("codes")
        found = averaged(written(own.coalesce(TRAINERS).mapInArrow(run, "part int, weight double, net binary"), "lm-parameters"))
        if found is not None:
            edges = np.cumsum([np.prod(s) for s in shapes])[:-1]
            net = Net(*(p.reshape(s) for p, s in zip(np.split(np.frombuffer(found["net"], np.float32), edges), shapes)))
    return net


def _scored(table: DataFrame, known: Lexicon, net: Net, id_col: str) -> DataFrame:
    """Sums over each row's tokens that the lexicon knows."""
    logs, here, inner = np.log10(known.counts + 1.0), (known.counts > 0).astype(np.int64), known.inner
    symbol, cuts, end = known.symbol, known.cuts, known.end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z, codes, sizes in _documents(batch.column(4)):
                found = log_probabilities(net, cuts, end, symbol[codes], sizes) / np.log(10)
                starts = np.cumsum(sizes) - sizes
                sums = [np.add.reduceat(x[codes], starts) for x in (inner, logs, here)]
                columns = [pa.array(found + sums[0]), pa.array(sums[1]), pa.array(sums[2], pa.int64())]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, z - a) for c in batch.columns[:4]), *columns], names=names)
                pa.default_memory_pool().release_unused()

    names = ["row", id_col, "held_out", "n_tokens", "score", "logs", "n_known"]
    kind = table.schema[id_col].dataType.simpleString()
    schema = f"row bigint, `{id_col}` {kind}, held_out boolean, n_tokens bigint, score double, logs double, n_known bigint"
    return table.select("row", id_col, "held_out", "n_tokens", "codes").mapInArrow(run, schema)


def score(
    documents: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text: str = "text",
    dictionary: int = DICTIONARY,
    symbols: int = SYMBOLS,
) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row.

    Tokens are the words of the text with A to Z in lower case, then one end; a null text has the end alone.
    ``base_score`` adds log10((c + 1) / (N + V + 1)) over the tokens, with counts from all rows for which
    ``held_out`` isn't true; ``score`` is the recurrent model's log10 probability of the text. Rows without an
    id and repeated rows are scored, and learnt from, like others. Without training rows the model is its
    starting point. An empty table gives an empty result. Only the two columns, and those of ``held_out``, are read.
    """
    held_out = F.coalesce(held_out, F.lit(False))
    counts = written(word_counts(documents, text, held_out), "lm-counts")
    ends = documents.where(~held_out).count()
    sums = counts.agg(F.sum("c").alias("total"), F.count_if(F.col("c") > 0).alias("different")).first()
    short = most_frequent(counts.where(F.octet_length("word") <= WORD_BYTES), "n", dictionary).toArrow().sort_by("word")
    total, different = int(sums["total"] or 0) + ends, sums["different"] + (ends > 0)
    known = lexicon(short.column("word").to_pylist(), short.column("c").to_numpy(), ends, total, different, symbols)
    table = written(coded(documents, held_out, known, id_col, text), "lm-codes")
    found = _scored(table, known, trained(table, known), id_col)
    rare = table.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.words", "w.times")
    joined = rare.join(counts, F.col("words") == F.col("word"), "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("rare_logs"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    logs = F.coalesce("rare_logs", F.lit(0.0))
    rows = found.join(joined, "row", "left")
    denominator = float(np.log10(total + different + 1))
    return rows.select(
        id_col,
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * denominator).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )
