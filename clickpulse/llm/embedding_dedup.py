"""Embedding near-duplicates by spherical-cap filters from a structured product code.

The dimensions are cut into two halves, each with a code of unit directions made of random rotations.
A filter is a pair of codewords, one per half. A vector falls into every filter whose direction scores
within a margin of its best one; the list of those is decoded from the two halves' scores, never by
scoring all filters. Near vectors share a filter; the vectors of a filter are compared in double precision.
Margin and size of the code follow from the cosine, the dimension and the number of vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.blocks import compare, forest, pieces, shuffle_parts
from clickpulse.llm.shared import connected_components, written

COSINE = 0.98
#: How many standard deviations of the difference of two scores the margin allows for. Pairs at the cosine exactly then
#: shared a filter in all of 400 trials for each of 11 dimensions from 1 to 1,536 and cosines of 0.9, 0.95, 0.98 and
#: 0.99; more finds more distant pairs and costs more rows.
DEVIATIONS = 1.5
#: Filters of a vector on average, at most; a code with more gets fewer codewords, so larger caps.
LIST = 100
SEED = 7
#: Rows of scores that a task holds at a time.
STEP = 512


def codewords(n: int) -> int:
    """Codewords of each half, so that their pairs outnumber n vectors about 32 to 1."""
    return 1 << min(13, max(5, math.ceil(math.log2(math.sqrt(32 * max(n, 1))))))


def margin_of(dim: int, words: int, cosine: float) -> float:
    """How far below its best score a vector's other filters may be.

    A vector at the cosine loses a share of the best score, which is that of the largest of so many directions, and
    its score there differs by a normal amount that shrinks with the root of the dimension.
    """
    best = min(1.0, math.sqrt(2 * math.log(max(2, words ** (2 if dim >= 4 else 1))) / dim))
    return best * (1 - cosine) + DEVIATIONS * math.sqrt(max(0.0, 1 - cosine * cosine)) / math.sqrt(dim)


def planned(dim: int, n: int, cosine: float) -> tuple[int, float]:
    """Codewords of each half and the margin for n vectors, with lists of ``LIST`` filters on average at most."""
    words = codewords(n)
    probe = unit_rows(np.random.default_rng((SEED, dim, 1)).standard_normal((64, dim)).tolist())
    while True:
        margin = margin_of(dim, words, cosine)
        if words <= 4 or np.mean([len(f) for f in list_decode(probe, product_code(dim, words), margin)]) <= LIST:
            return words, margin
        words //= 2


def product_code(dim: int, words: int, seed: int = SEED) -> list[np.ndarray]:
    """For each half of the dimensions: a matrix whose columns are unit directions, from random rotations."""
    rng = np.random.default_rng((seed, dim))
    code = []
    for part in np.array_split(np.arange(dim), 2 if dim >= 4 else 1):
        w = len(part)
        if w == 1:  # there are two directions only
            code.append(np.array([[1.0, -1.0]]))
            continue
        turns = [np.linalg.qr(rng.standard_normal((w, w)))[0] for _ in range(-(-words // w))]
        code.append(np.concatenate(turns, axis=1)[:, :words])
    return code


def list_decode(unit: np.ndarray, code: list[np.ndarray], margin: float) -> list[np.ndarray]:
    """The numbers of all filters that score within ``margin`` of the best, rising, for each row of ``unit``."""
    out, reach, words = [], margin * math.sqrt(len(code)), code[0].shape[1]
    cuts = np.cumsum([c.shape[0] for c in code])[:-1]
    for at in range(0, len(unit), STEP):
        halves = np.split(unit[at : at + STEP], cuts, axis=1)
        below = [(s := h @ c) - s.max(axis=1, keepdims=True) for h, c in zip(halves, code)]
        for row in zip(*below):
            near = [np.flatnonzero(r >= -reach) for r in row]
            if len(near) == 1:
                out.append(near[0])
                continue
            a, b = np.nonzero(row[0][near[0]][:, None] + row[1][near[1]][None, :] >= -reach)
            out.append(near[0][a] * words + near[1][b])
    return out


def unit_rows(vectors: list) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _coded(classes: DataFrame, plans: dict[int, tuple[int, float]]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes: dict[int, list[np.ndarray]] = {}
        for frame in batches:
            for dim, rows in frame.groupby("dim"):
                words, margin = plans[int(dim)]
                if dim not in codes:
                    codes[dim] = product_code(int(dim), words)
                unit = unit_rows(rows["embedding"].tolist())
                yield rows.drop(columns="embedding").assign(unit=list(unit), filters=list_decode(unit, codes[dim], margin))

    kind = classes.schema["label"].dataType.simpleString()
    schema = f"key bigint, label {kind}, dim int, copies bigint, unit array<double>, filters array<bigint>"
    return classes.select("key", "label", "dim", "copies", "embedding").mapInPandas(run, schema)


def _shared(lists: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Whether two lists have a number in common, for each pair of them. So many numbers are looked at at a time."""
    names, column, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(lists)), [len(f) for f in lists])
    often = times > 1  # a number of one list only is shared by none
    place = np.cumsum(often) - 1
    row, column = row[often[column]], place[column[often[column]]]
    found = np.zeros((len(lists), len(lists)), bool)
    for first in range(0, int(often.sum()), columns):
        own = (column >= first) & (column < first + columns)
        member = np.zeros((len(lists), columns), np.float32)
        member[row[own], column[own] - first] = 1
        found |= (member @ member.T) > 0
    return found


def _near(cosine: float):
    def piece_links(rows: pd.DataFrame) -> pd.DataFrame | None:
        unit = np.stack(rows["unit"].to_numpy())
        chunk, left, right = rows["chunk"].to_numpy(), rows["left"].iloc[0], rows["right"].iloc[0]
        near = unit @ unit.T >= cosine
        np.fill_diagonal(near, False)
        if left != right:
            near &= chunk[:, None] != chunk[None, :]
        linked = np.flatnonzero(near.any(axis=1))
        if not len(linked):
            return None
        near = near[np.ix_(linked, linked)]
        # a link counts in the first filter that both ends share
        earlier = [np.asarray(f)[np.asarray(f) < rows["filter"].iloc[0]] for f in rows["filters"].to_numpy()[linked]]
        near &= ~_shared(earlier)
        copies, key = rows["copies"].to_numpy()[linked], rows["key"].to_numpy()[linked]
        child, root = forest(*np.nonzero(near), len(linked))
        below = np.arange(len(linked))
        below[child] = root
        return pd.DataFrame({"key": key, "n": near @ copies, "root": key[below]})

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        found = [piece_links(rows) for _, rows in frame.groupby("piece", sort=False)]
        found = [f for f in found if f is not None]
        return pd.concat(found) if found else pd.DataFrame({"key": [], "n": [], "root": []}, dtype=np.int64)

    return work


def links(classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``key, n, root``: for pieces of filters, what each vector links with there, and links that join the same groups.

    ``classes`` is a written table of different vectors (key, label, dim, copies, embedding). Its few lengths of vector
    come to the driver.
    """
    sizes = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    plans = {dim: planned(dim, n, cosine) for dim, n in sizes.items()}
    coded = written(_coded(classes, plans), "embedding-filters")
    keys = ["label", "dim", "filter"]
    spread = written(coded.select("key", "label", "dim", F.explode("filters").alias("filter")), "filter-members")
    cut = pieces(spread, keys, "key").join(coded.select("key", "copies", "unit", "filters"), "key")
    return compare(cut, keys, _near(cosine), "key bigint, n bigint, root bigint", shuffle_parts(classes))


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """``id_col, n_links, component_id, kept`` for each row of ``vectors``.

    Only rows of equal label and equal length are compared. A row whose label is null, or whose vector
    is null, empty, all zero or holds a null or non-finite number, links with nothing. ``n_links``
    counts the other rows linked directly, copies included; ``component_id`` is the smallest id that
    links reach, itself included; ``kept`` says that it is the row's own. Equal vectors are one node.
    Repeated rows stay and count as copies; a null id is never the smallest unless all are null, and is
    kept only where it links with nothing.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("embedding"), F.col(label).alias("label"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    good = F.coalesce(F.col("label").isNotNull() & ~bad & some, F.lit(False))
    sound = rows.where(good)
    grouped = sound.groupBy("label", "embedding").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    grouped = grouped.withColumn("dim", F.size("embedding")).withColumn("key", F.monotonically_increasing_id())
    classes = written(grouped, "embedding-classes")
    found = written(links(classes, cosine), "embedding-links")
    counts = found.groupBy("key").agg(F.sum("n").alias("n"))
    groups = connected_components(found, "key", "root").withColumnRenamed("id", "key")
    classes = classes.join(counts, "key", "left").join(groups, "key", "left")
    classes = classes.withColumn("component", F.coalesce("component", "key"))
    classes = classes.withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("copies") - 1)
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "component").select("label", "embedding", "n_links", "component_id")
    joined = sound.join(named, ["label", "embedding"]).select("id", "n_links", "component_id")
    alone = rows.where(~good).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return joined.unionByName(alone).withColumn("kept", kept).withColumnRenamed("id", id_col)
