"""Comparing the members of each bucket in bounded pieces.

A bucket with more members than a piece holds is cut into chunks, and every pair of its chunks
becomes a piece of its own. So no task gets an unbounded group, whatever the size of a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1024


def pieces(rows: DataFrame, keys: Sequence[str], member: str, size: int = PIECE) -> DataFrame:
    """Rows of buckets with two members or more, with ``chunk``, ``left`` and ``right`` added.

    ``left`` and ``right`` name the pair of chunks that a piece compares; a row goes to each pair
    that its chunk is part of. ``rows`` should be a written table, as it is read twice.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1")
    chunks = F.ceil(F.col("__n") / size).cast("int")
    found = rows.join(counts, list(keys)).withColumn("__chunks", chunks)
    found = found.withColumn("chunk", F.pmod(F.xxhash64(member), F.col("__chunks")).cast("int"))
    found = found.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1)))
    found = found.withColumn("left", F.least("chunk", "__other")).withColumn("right", F.greatest("chunk", "__other"))
    return found.drop("__n", "__chunks", "__other")


def compare(
    cut: DataFrame, keys: Sequence[str], work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, parts: int
) -> DataFrame:
    """Runs ``work`` over whole pieces, as many at a time as come in one batch.

    ``work`` gets a frame sorted by ``piece``, a running number of the pieces in it.
    """
    by = [*keys, "left", "right"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            piece = (frame[by] != frame[by].shift()).any(axis=1).cumsum()
            last = piece == piece.iloc[-1]
            rest = frame[last]
            if not last.all():
                yield work(frame[~last].assign(piece=piece[~last]).reset_index(drop=True))
        if rest is not None:
            yield work(rest.assign(piece=0).reset_index(drop=True))

    return cut.repartition(parts, *by).sortWithinPartitions(*by).mapInPandas(run, schema)


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each member that has links, and the smallest member that it reaches."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            child = np.flatnonzero(root != np.arange(n))
            return child, root[child]
