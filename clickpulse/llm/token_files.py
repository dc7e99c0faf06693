"""Token files: flat unsigned integers and 64-bit document offsets, written by Spark tasks and memory-mapped.

``part-NNNNN.bin`` holds the ids of a range of documents one after the other, ``part-NNNNN.idx`` the
offsets of the documents in it (one more than documents, 64-bit), ``part-NNNNN.doc`` their ids (64-bit
signed; the smallest number stands for null). ``manifest.json`` lists each part's documents, tokens and
base: the tokens of all parts before it, a prefix sum. All numbers are little-endian.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.llm.blocks import shuffle_parts
from clickpulse.llm.tokens import library_encoder

NULL_ID = -(1 << 63)
#: Documents encoded, and tokens read, at a time.
DOCS, TOKENS = 2048, 1 << 20


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int, width: str) -> pa.RecordBatch:
    context = TaskContext.get()
    part, attempt = context.partitionId(), context.taskAttemptId()
    fs, root = pafs.FileSystem.from_uri(folder)
    encoder, end = library_encoder(path), end_id.to_bytes(4, "little")
    names = {kind: f"{root}/.part-{part:05d}-{attempt}.{kind}" for kind in ("bin", "idx", "doc")}
    docs, at = 0, 0
    with fs.open_output_stream(names["bin"]) as out, fs.open_output_stream(names["idx"]) as idx, fs.open_output_stream(names["doc"]) as doc:
        idx.write(np.zeros(1, "<i8").tobytes())
        for batch in batches:
            for first in range(0, batch.num_rows, DOCS):
                rows = batch.slice(first, DOCS)
                found = [ids + end for ids in encoder.encode(rows.column(1).to_pylist())]
                out.write(np.frombuffer(b"".join(found), "<u4").astype(width).tobytes())
                sizes = [len(ids) // 4 for ids in found]
                ends = at + np.cumsum(sizes)
                idx.write(ends.astype("<i8").tobytes())
                doc.write(np.array([NULL_ID if i is None else i for i in rows.column(0).to_pylist()], "<i8").tobytes())
                docs, at = docs + len(sizes), int(ends[-1])
    for kind, name in names.items():  # the last step: a part is whole or absent, and a second attempt writes the same
        fs.move(name, f"{root}/part-{part:05d}.{kind}")
    return pa.RecordBatch.from_pydict({"part": [part], "docs": [docs], "tokens": [at]})


def write(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text: str = "text",
    width: str = "<u2",
) -> list[dict]:
    """Writes all documents in ascending order of id (nulls first, equal ids by text) and returns the manifest.

    ``folder`` is new and shared by all executors. ``width`` is ``<u2`` for vocabularies below 65,536,
    else ``<u4``. A null text is an empty document, which holds the end id alone. An id that is no long
    counts as null. A special token's string in a text becomes that token. The manifest has an entry
    per part, whatever the number of documents.
    """
    pafs.FileSystem.from_uri(folder)[0].create_dir(pafs.FileSystem.from_uri(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _write_part(batches, folder, tokenizer, end_id, width)

    rows = documents.select(F.col(id_col).try_cast("bigint").alias(id_col), F.col(text))
    order = (F.col(id_col), F.xxhash64(text), F.col(text))
    # equal ids may fill several parts; texts stay out of the bounds, which the driver holds
    ranged = rows.repartitionByRange(shuffle_parts(documents), *order[:2]).sortWithinPartitions(*order)
    parts = ranged.mapInArrow(run, "part bigint, docs bigint, tokens bigint").collect()  # one row per part
    parts = sorted(parts, key=lambda p: p["part"])
    bases = accumulate((p["tokens"] for p in parts), initial=0)
    manifest = [p.asDict() | {"base": b, "width": width} for p, b in zip(parts, bases)]
    fs, root = pafs.FileSystem.from_uri(folder)
    with fs.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def _mapped(fs: pafs.FileSystem, name: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where the file system is local, else read."""
    if isinstance(fs, pafs.LocalFileSystem):
        with pa.memory_map(name) as source:
            return np.frombuffer(source.read_buffer(), kind)
    with fs.open_input_file(name) as source:
        return np.frombuffer(source.readall(), kind)


def _read_part(folder: str, part: int, base: int, width: str) -> Iterator[pa.RecordBatch]:
    fs, root = pafs.FileSystem.from_uri(folder)
    offsets = _mapped(fs, f"{root}/part-{part:05d}.idx", "<i8")
    docs = _mapped(fs, f"{root}/part-{part:05d}.doc", "<i8")
    ids = _mapped(fs, f"{root}/part-{part:05d}.bin", width) if len(docs) else np.zeros(0, width)
    first = 0
    while first < len(docs):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + TOKENS, "right")) - 1)
        tokens = [ids[offsets[k] : offsets[k + 1]].astype("<u4").tobytes() for k in range(first, last)]
        names = pa.array(docs[first:last], pa.int64(), mask=docs[first:last] == NULL_ID)
        starts = pa.array(offsets[first:last] + base, pa.int64())
        yield pa.RecordBatch.from_arrays([names, starts, pa.array(tokens, pa.binary())], names=["doc_id", "start", "tokens"])
        first = last


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, tokens``: each document's ids as little-endian unsigned 32-bit integers, end id included.

    ``start`` counts the ids of all documents before it in the whole set of files.
    """
    fs, root = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{root}/manifest.json") as source:
        manifest = json.loads(source.readall())
    parts = spark.createDataFrame(
        [(p["part"], p["base"], p["width"]) for p in manifest], "part bigint, base bigint, width string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _read_part(folder, row["part"], row["base"], row["width"])

    spread = parts.repartition(max(1, len(manifest)), "part") if manifest else parts
    return spread.mapInArrow(run, "doc_id bigint, start bigint, tokens binary")
