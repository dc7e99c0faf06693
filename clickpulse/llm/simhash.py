"""SimHash near-duplicates: fingerprints, pigeonhole blocks, and the groups that close pairs form.

A fingerprint's 64 bits are cut into blocks. Two fingerprints that differ in at most d bits agree in
all but d blocks at least, so they meet in the bucket of some choice of blocks. The number of blocks
follows from the number of different fingerprints, which keeps a bucket's expected size small; every
choice is exact. Members of a bucket are compared and only a forest of their links is passed on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.blocks import compare, forest, pieces, shuffle_parts
from clickpulse.llm.shared import connected_components, written

SHINGLE = 3
DISTANCE = 3
SEED = 42
BITS = 64
#: Hashes whose bits are counted at a time.
STEP = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the bits of all shingles' hashes, as a signed 64-bit number; 0 without a word."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:z], SEED) for a, z in zip(starts, stops)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, STEP):
        bits = np.unpackbits(hashes[at : at + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id_col, fingerprint`` (a long) for each row. A null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = pa.array([fingerprint(t or b"", shingle) for t in batch.column(1).cast(pa.binary()).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), marks], names=[id_col, "fingerprint"])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, fingerprint bigint")


def plan_blocks(n: int, distance: int = DISTANCE) -> tuple[int, int]:
    """Blocks, and how many of them a pair must share, so that n random fingerprints rarely meet."""
    for blocks in range(distance + 1, 2 * distance + 4):
        shared = blocks - distance
        if (BITS // blocks) * shared >= math.log2(max(n, 2)) + 1:
            break
    return blocks, shared


def _bounds(blocks: int) -> list[tuple[int, int]]:
    cuts = [round(k * BITS / blocks) for k in range(blocks + 1)]
    return list(zip(cuts, cuts[1:]))


def block_keys(mark: Column, blocks: int, shared: int) -> Column:
    """One key for each choice of ``shared`` blocks: the choice's number and the chosen bits."""
    keys = []
    for number, choice in enumerate(combinations(_bounds(blocks), shared)):
        mask = sum(((1 << (z - a)) - 1) << a for a, z in choice)
        signed = mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask
        keys.append(F.struct(F.lit(number).alias("choice"), mark.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def _close(distance: int):
    def work(frame: pd.DataFrame) -> pd.DataFrame:
        marks, piece = frame["fingerprint"].to_numpy(), frame["piece"].to_numpy()
        found_a, found_b = [], []
        index, step = np.arange(len(marks)), 1
        while True:
            index = index[: np.searchsorted(index, len(marks) - step)]
            index = index[piece[index] == piece[index + step]]
            if not len(index):
                break
            near = index[np.bitwise_count((marks[index] ^ marks[index + step]).view(np.uint64)) <= distance]
            found_a.append(near)
            found_b.append(near + step)
            step += 1
        a = np.concatenate(found_a) if found_a else index
        b = np.concatenate(found_b) if found_b else index
        child, root = forest(a, b, len(marks))
        return pd.DataFrame({"a": marks[child], "b": marks[root]}).drop_duplicates()

    return work


def links(marks: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: links that join all different fingerprints within ``distance`` bits, directly or by others.

    ``marks`` is a written table of different fingerprints.
    """
    n = marks.count()
    keyed = marks.select("fingerprint", F.explode(block_keys(F.col("fingerprint"), *plan_blocks(n, distance))).alias("k"))
    keyed = written(keyed.select("fingerprint", "k.choice", "k.bits"), "simhash-blocks")
    keys = ["choice", "bits"]
    return compare(pieces(keyed, keys, "fingerprint"), keys, _close(distance), "a bigint, b bigint", shuffle_parts(marks))


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """``id_col, fingerprint, component_id`` for each row of ``documents``.

    ``component_id`` is the smallest id that links of at most ``distance`` bits reach, itself
    included. Texts without a word (null, empty, blank) share fingerprint 0 and are linked like any
    others. Repeated rows stay; null ids are kept and never the smallest unless all are null. Equal
    fingerprints are one node, so groups of copies cost no pairs. Only the two columns are read.
    """
    marks = written(fingerprints(documents, id_col, text, shingle), "fingerprints")
    classes = written(marks.groupBy("fingerprint").agg(F.min(id_col).alias("__least")), "fingerprint-classes")
    close = written(links(classes.select("fingerprint"), distance), "simhash-links")
    linked = connected_components(close, "a", "b").withColumnRenamed("id", "fingerprint")
    classes = classes.join(linked, "fingerprint", "left")
    classes = classes.withColumn("component", F.coalesce("component", "fingerprint"))
    least = classes.groupBy("component").agg(F.min("__least").alias("component_id"))
    named = classes.join(least, "component").select("fingerprint", "component_id")
    return marks.join(named, "fingerprint").select(id_col, "fingerprint", "component_id")


def keep_one(
    documents: DataFrame, id_col: str = "doc_id", text: str = "text", repeats: bool = True, **options
) -> DataFrame:
    """The documents that come first in their group; each row is judged by its own text.

    Rows go by id, nulls last. With ``repeats`` all rows that carry their group's smallest id stay, and
    so do rows with a null id; without, exactly one row of each group does, whatever the ids are. The
    documents are written once with a number for each row, which tells rows with equal ids apart.
    """
    rows = written(documents.withColumn("__row", F.monotonically_increasing_id()), "numbered-documents")
    key = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("__row").alias("row"))
    groups = near_duplicates(rows.select(key.alias("__key"), text), "__key", text, **options)
    lost = F.col("__key.id") != F.col("component_id.id") if repeats else F.col("__key") != F.col("component_id")
    dropped = groups.where(lost).select(F.col("__key.row").alias("__row"))
    return rows.join(dropped, "__row", "left_anti").select(documents.columns)


def hex_digits(mark: Column) -> Column:
    return F.lower(F.lpad(F.hex(mark), 16, "0"))
