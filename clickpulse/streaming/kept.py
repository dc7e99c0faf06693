"""Results that are kept up to date by micro-batches and read as one small table.

Each batch adds a folder with its own part. Parts merge by an aggregation that may be applied again to its
results, such as sums or minima by key. From time to time the parts are merged into one base whose name
tells the last batch in it. So a reader opens the newest base and the batches after it, and a batch that
runs again replaces its part, or is left out if the base has it already.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickpulse.streaming.sinks import BatchWriter, discard, listed

Merge = Callable[[DataFrame], DataFrame]


class Kept:
    """A table under ``path`` with the rows of ``schema``, which ``merge`` gives and takes.

    ``every`` is the number of batches after which a writer merges.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Merge, every: int = 64) -> None:
        self.spark, self.path, self.schema, self.merge, self.every = spark, path, schema, merge, every

    def _base(self) -> int | None:
        """The last batch of the newest whole base."""
        found = [int(n.removeprefix("upto=")) for n in listed(self.spark, f"{self.path}/base")]
        whole = [n for n in found if "_SUCCESS" in listed(self.spark, f"{self.path}/base/upto={n}", hidden=True)]
        return max(whole, default=None)

    def _after(self, base: int | None) -> list[int]:
        """Batches that no base has; at most ``every`` of them where a writer runs."""
        found = (int(n.removeprefix("batch=")) for n in listed(self.spark, f"{self.path}/new"))
        return sorted(n for n in found if base is None or n > base)

    def has(self, batch_id: int) -> bool:
        """Whether a batch has been added before."""
        base = self._base()
        return (base is not None and batch_id <= base) or batch_id in self._after(base)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Adds a batch; doing so again replaces it."""
        base = self._base()
        if base is not None and batch_id <= base:
            return
        self.merge(batch).write.mode("overwrite").parquet(f"{self.path}/new/batch={batch_id}")
        if len(self._after(base)) >= self.every:
            self.compact()

    def writer(self, part: Merge = lambda batch: batch) -> BatchWriter:
        """Adds ``part`` of every micro-batch."""

        def write(batch: DataFrame, batch_id: int) -> None:
            self.add(part(batch), batch_id)

        return write

    def _parts(self, base: int | None, after: list[int]) -> DataFrame:
        paths = [f"{self.path}/new/batch={n}" for n in after]
        if base is not None:
            paths.insert(0, f"{self.path}/base/upto={base}")
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        """Everything added so far, merged."""
        base = self._base()
        return self.merge(self._parts(base, self._after(base)))

    def compact(self) -> None:
        """Merges all parts into a new base. What it replaces goes once the new one is whole."""
        base = self._base()
        after = self._after(base)
        if after:
            self.merge(self._parts(base, after)).write.mode("overwrite").parquet(f"{self.path}/base/upto={after[-1]}")
            base = after[-1]
        for name in listed(self.spark, f"{self.path}/base"):
            if base is not None and int(name.removeprefix("upto=")) < base:
                discard(self.spark, f"{self.path}/base/{name}")
        for name in listed(self.spark, f"{self.path}/new"):
            if base is not None and int(name.removeprefix("batch=")) <= base:
                discard(self.spark, f"{self.path}/new/{name}")
