"""Shared folder, written intermediate tables, and the connected components of a link table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the one that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may do without.
    """
    root = spark.conf.get(DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {DIR} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="clickpulse-")
        spark.conf.set(DIR, root)
    return f"{root.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex[:12]}"


def _stored(df: DataFrame, purpose: str, compression: str = "snappy") -> tuple[DataFrame, str]:
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage is cut, a lost executor costs nothing."""
    return _stored(df, purpose, compression)[0]


def _discard(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate table that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def most_frequent(rows: DataFrame, number: str, limit: int) -> DataFrame:
    """The rows whose ``number`` (1 or more) reaches a bound that at most ``limit`` rows reach, without a sort.

    The bound is one of 64 steps for each doubling, so the driver gets some 4,000 counts at most.
    """
    level = F.floor(F.log2(F.col(number)) * 64)
    bound, total = None, 0
    for row in rows.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        total += row["count"]
        if total > limit:
            break
        bound = row["level"]
    return rows.where(F.lit(False)) if bound is None else rows.where(level >= bound)


def _min_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``id, component`` (the smallest id reachable) for every id of the undirected link table.

    Alternates two steps until every id hangs directly below its smallest: an id's larger
    neighbours move to its smallest neighbour, then its smaller ones do. Each step is a grouped
    minimum, combined before the shuffle, and a join that can be split where one id has very many
    links. Rows never grow over twice the links. A step's table goes once the next is written. Null
    ends and self links are ignored; an empty table gives an empty result.
    """
    down = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    spark, before = links.sparkSession, None
    state, at = _stored(down.distinct(), "links")
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return state.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                state.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        before = mark
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _min_neighbour(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, between = _stored(large, "links")
        least = _min_neighbour(large)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old = at
        state, at = _stored(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
        for path in (old, between):
            _discard(spark, path)
