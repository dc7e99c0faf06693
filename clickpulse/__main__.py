"""Runs one job: ``python -m clickpulse JOB OUT [--files FOLDER] [--once]``.

Records come from the topic at the endpoint that the environment names, or from a folder of JSON files.
Results go below the folder OUT; reports are printed too.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickpulse.schema import MONITOR_INTERVAL_S
from clickpulse.session import build_session
from clickpulse.sources import records
from clickpulse.sources.endpoints import endpoint
from clickpulse.streaming import jobs, sinks

Job = Callable[[DataFrame, str, dict | None], StreamingQuery]


def _gmv(raw: DataFrame, out: str, trigger: dict | None) -> StreamingQuery:
    return jobs.gmv_job(raw, _both(sinks.printer("line"), sinks.file_writer(f"{out}/lines")), f"{out}/checkpoint", trigger)


def _hot(raw: DataFrame, out: str, trigger: dict | None) -> StreamingQuery:
    every = [sinks.printer("report"), sinks.file_writer(f"{out}/reports")]
    return jobs.hot_search_job(raw, f"{out}/checkpoint", every=every, trigger=trigger)


def _olap(raw: DataFrame, out: str, trigger: dict | None) -> StreamingQuery:
    return jobs.olap_job(raw, sinks.olap_writer(f"{out}/rows"), f"{out}/checkpoint", trigger, within=jobs.REPLAYED)


def _archive(raw: DataFrame, out: str, trigger: dict | None) -> StreamingQuery:
    return jobs.archive_job(raw, f"{out}/rows", f"{out}/arrivals", f"{out}/checkpoint", trigger)


def _monitor(raw: DataFrame, out: str, trigger: dict | None) -> StreamingQuery:
    write = sinks.filling_writer(sinks.file_writer(f"{out}/intervals"), f"{out}/last", MONITOR_INTERVAL_S * 1000)
    return jobs.monitor_job(raw, write, f"{out}/checkpoint", trigger)


def _cube(raw: DataFrame, out: str, trigger: dict | None) -> StreamingQuery:
    return jobs.cube_job(raw, f"{out}/parts", f"{out}/checkpoint", trigger)


def _both(*writers: sinks.BatchWriter) -> sinks.BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        for one in writers:
            one(batch, batch_id)

    return write


#: Each job, and the offsets it begins with where it has no checkpoint.
JOBS: dict[str, tuple[Job, str]] = {
    "gmv": (_gmv, "latest"),
    "hot": (_hot, "earliest"),
    "olap": (_olap, "latest"),
    "archive": (_archive, "latest"),
    "monitor": (_monitor, "latest"),
    "cube": (_cube, "earliest"),
}


def source(spark: SparkSession, files: str | None, starting: str) -> DataFrame:
    """The folder's records, or those of the topic at ``KAFKA_BOOTSTRAP_SERVERS``."""
    if files:
        return records.file_stream(spark, files)
    return records.topic_stream(spark, endpoint("KAFKA_BOOTSTRAP_SERVERS"), starting=starting)


def run(spark: SparkSession, name: str, out: str, files: str | None = None, once: bool = False) -> StreamingQuery:
    job, starting = JOBS[name]
    return job(source(spark, files, starting), out, jobs.ALL if once else None)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="clickpulse", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("out")
    parser.add_argument("--files", help="a folder of JSON records instead of the topic")
    parser.add_argument("--once", action="store_true", help="stop when everything there is has been read")
    given = parser.parse_args(arguments)
    run(build_session(f"clickpulse-{given.job}"), given.job, given.out, given.files, given.once).awaitTermination()


if __name__ == "__main__":
    main()
