"""Batch writers for ``foreachBatch``.

Spark may run a micro-batch again after a failure. Every file writer here puts a batch's
rows under ``batch_id=N`` and overwrites just that, so a second run leaves no duplicates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators.archive import partition_commits
from clickpulse.schema import COMMIT_DELAY_MS

BatchWriter = Callable[[DataFrame, int], None]


def _write_batch(rows: DataFrame, batch_id: int, path: str, fmt: str, by: tuple[str, ...]) -> None:
    writer = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.format(fmt)
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, "batch_id").save(path)


def file_writer(
    path: str, *, fmt: str = "parquet", by: tuple[str, ...] = (), sort: tuple[str, ...] = ()
) -> BatchWriter:
    """Files per batch, partitioned by ``by`` and sorted by ``sort`` inside each file."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.sortWithinPartitions(*by, *sort) if sort else batch
        _write_batch(rows, batch_id, path, fmt, by)

    return write


def read_files(spark: SparkSession, path: str, like: DataFrame, fmt: str = "parquet") -> DataFrame:
    """What a :func:`file_writer` has written so far, with the columns of ``like``."""
    return spark.read.format(fmt).schema(like.schema).load(path).select(*like.columns)


def olap_writer(path: str) -> BatchWriter:
    """OLAP rows as Parquet, sorted by ``ts``."""
    return file_writer(path, sort=("ts",))


def jdbc_writer(url: str, table: str, batch_rows: int = 500, **properties: str) -> BatchWriter:
    """Append to a database table in batches of ``batch_rows``. Each task opens its own
    connection. Delivery is at least once, as the table has no key to overwrite by."""

    def write(batch: DataFrame, batch_id: int) -> None:
        options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **properties}
        batch.write.format("jdbc").options(**options).mode("append").save()

    return write


def index_writer(index: str, nodes: str, bulk_rows: int = 50, fmt: str = "es", **options: str) -> BatchWriter:
    """Bulk-index documents with a search connector on the classpath. The document id is
    ``event_id``, so a replay overwrites."""
    settings = {
        "es.nodes": nodes,
        "es.mapping.id": "event_id",
        "es.batch.size.entries": str(bulk_rows),
        **options,
    }

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).options(**settings).mode("append").save(index)

    return write


def topic_writer(servers: str, topic: str, **options: str) -> BatchWriter:
    """Publish ``key`` and ``value`` to a topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        settings = {"kafka.bootstrap.servers": servers, "topic": topic, **options}
        batch.select("key", "value").write.format("kafka").options(**settings).save()

    return write


def upsert_writer(put: Callable[[str, str], None], value: str = "report") -> BatchWriter:
    """Calls ``put(field, value)`` for every row of a batch: a report, or a line for each rank.
    ``put`` is a hash store's upsert, such as HSET on a fixed hash."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for row in batch.select("field", value).toLocalIterator():
            put(row["field"], row[value])

    return write


def printer(column: str, order: str = "window_end", out: Callable[[str], None] = print) -> BatchWriter:
    """Prints a text column of every row of a batch: one line or report per closed window."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for row in batch.orderBy(order).select(column).toLocalIterator():
            out(row[column])

    return write


def latest_value(stored: DataFrame) -> DataFrame:
    """Newest report per field out of files written batch by batch."""
    return stored.groupBy("field").agg(
        F.max_by("report", "window_end").alias("report"), F.max("window_end").alias("window_end")
    )


def _files(spark: SparkSession, path: str):
    """Hadoop's path and its file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def listed(spark: SparkSession, path: str, *, hidden: bool = False) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    target, system = _files(spark, path)
    names = sorted(f.getPath().getName() for f in system.listStatus(target)) if system.exists(target) else []
    return [n for n in names if hidden or n[0] not in "._"]


def discard(spark: SparkSession, path: str) -> None:
    target, system = _files(spark, path)
    system.delete(target, True)


def archive_writer(path: str, arrivals: str) -> BatchWriter:
    """Archive rows into ``dt`` folders, and per batch the first arrival of each day, which
    :func:`commit_days` reads. Rows carry the arrival ``timestamp``.

    Tasks write a batch straight into the day folders, under names that begin with its number; nothing is
    moved afterwards. A mark tells that a batch has begun. Where it is found, or the batch's arrivals
    are, an earlier run has written files of that number, and they go first, so a replay leaves no duplicates.
    The catalog needs one partition per day.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, begun = batch.sparkSession, f"{path}/_begun/batch-{batch_id}"
        if _exists(spark, begun) or first_arrivals(spark, arrivals).has(batch_id):
            _clear(spark, path, batch_id)
        rows = batch.persist()
        try:
            _touch(spark, begun)
            named = rows.drop("timestamp").write.option("mapreduce.output.basename", f"batch-{batch_id}")
            named.mode("append").partitionBy("dt").parquet(path)
            first_arrivals(spark, arrivals).add(rows.select("dt", "timestamp"), batch_id)
            discard(spark, begun)
        finally:
            rows.unpersist()

    return write


def _exists(spark: SparkSession, file: str) -> bool:
    target, system = _files(spark, file)
    return system.exists(target)


def _clear(spark: SparkSession, path: str, batch_id: int) -> None:
    """Deletes a batch's files from all days."""
    target, system = _files(spark, f"{path}/dt=*/batch-{batch_id}-*")
    for old in system.globStatus(target) or ():
        system.delete(old.getPath(), False)


def first_arrivals(spark: SparkSession, path: str):
    """The kept table of each day's first arrival."""
    from clickpulse.streaming.kept import Kept

    def earliest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("dt").agg(F.min("timestamp").alias("timestamp"))

    return Kept(spark, path, "dt string, timestamp timestamp", earliest)


NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def commit_days(
    spark: SparkSession,
    path: str,
    arrivals: str,
    as_of_ms: int,
    *,
    table: str | None = None,
    delay_ms: int = COMMIT_DELAY_MS,
) -> list[str | None]:
    """Publishes the days that are due: a ``_SUCCESS`` file in the day's folder and, where a
    table is named, one partition in the catalog. Rows without a readable time have the day null,
    in the default partition. Safe to run again; only day names come to the driver.

    The first arrivals of all batches so far are merged, a row for each day, so a call reads that and the
    batches since the call before. A day that the table has is not added again.
    """
    seen = first_arrivals(spark, arrivals)
    seen.compact()
    due = partition_commits(seen.read(), as_of_ms, delay_ms).filter("committed").select("dt")
    days = sorted((row["dt"] for row in due.toLocalIterator()), key=lambda d: (d is None, d))
    have = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator()} if table else set()
    for day in days:
        name = f"dt={NULL_DAY if day is None else day}"
        if table and name not in have:
            spec = "null" if day is None else f"'{day}'"
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (dt = {spec})")
        _touch(spark, f"{path}/{name}/_SUCCESS")
    return days


def _touch(spark: SparkSession, file: str) -> None:
    """Makes an empty file on whatever file system the path names."""
    target, system = _files(spark, file)
    if not system.exists(target):
        system.create(target).close()


def filling_writer(write: BatchWriter, path: str, step_ms: int) -> BatchWriter:
    """Hands closed intervals on with those between them that had no record, all counters and rates zero.

    The last interval of the batches before is kept under ``path``, so a gap across batches is filled too, and
    a batch that runs again fills the same. Only the first and the last time of a batch come to the driver.
    """

    def fill(batch: DataFrame, batch_id: int) -> None:
        spark, rows = batch.sparkSession, batch.persist()
        try:
            span = rows.agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi")).first()
            earlier = sorted(int(n) for n in listed(spark, path) if int(n) < batch_id)
            last = _read_number(spark, f"{path}/{earlier[-1]}") if earlier else None
            if span["lo"] is None:
                write(rows, batch_id)
                return
            first = span["lo"] if last is None else min(last + step_ms, span["lo"])
            starts = spark.range(first, span["hi"] + 1, step_ms).withColumnRenamed("id", "window_start")
            zeros = [c for c in rows.columns if c != "window_start"]
            write(starts.join(rows, "window_start", "left").fillna(0, subset=zeros).select(*rows.columns), batch_id)
            _write_number(spark, f"{path}/{batch_id}", max(span["hi"], span["hi"] if last is None else last))
            for old in earlier[:-1]:
                discard(spark, f"{path}/{old}")
        finally:
            rows.unpersist()

    return fill


def _write_number(spark: SparkSession, file: str, number: int) -> None:
    target, system = _files(spark, file)
    out = system.create(target, True)
    out.writeLong(number)
    out.close()


def _read_number(spark: SparkSession, file: str) -> int:
    target, system = _files(spark, file)
    source = system.open(target)
    try:
        return source.readLong()
    finally:
        source.close()
