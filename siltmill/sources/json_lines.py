"""Lines of JSON from files that may be damaged, with what was damaged told apart from what was read."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltmill.storage import store_of

CHUNK, BATCH_BYTES = 1 << 20, 4 << 20
LINES = "file string, line long, text string, is_cut boolean"
_ARROW = pa.schema([("file", pa.string()), ("line", pa.int64()), ("text", pa.string()), ("is_cut", pa.bool_())])


def lines_of(raw: BinaryIO, packed: bool) -> Iterator[tuple[str | None, bool]]:
    """(line, False) for each line that is not blank, in order, None for a blank one, and (None, True) at the end of a
    file that breaks off; what stands of its last line comes before that. Holds one chunk and one line."""
    stream, rest = (gzip.GzipFile(fileobj=raw) if packed else raw), []
    cut = False
    while True:
        try:
            data = stream.read1(CHUNK) if packed else stream.read(CHUNK)
        except (EOFError, OSError, zlib.error):
            data, cut = b"", True
        if not data:
            break
        *ended, last = data.split(b"\n")
        for part in ended:
            rest.append(part)
            line = b"".join(rest).decode("utf-8", "replace")
            yield (line if line.strip() else None), False
            rest = []
        rest.append(last)
    left = b"".join(rest).decode("utf-8", "replace")
    if left.strip():
        yield left, False
    if cut:
        yield None, True


def numbered_lines(spark: SparkSession, path: str, only: str = "*.json*") -> DataFrame:
    """file, line (from 0, blank ones counted), text, is_cut: the lines of all files below path, compressed if they end
    in .gz, and a row without a line for each file that breaks off.

    Spark lists the files and packs them into tasks by size without reading them; a task streams its files, holding a
    chunk, a line and a batch of 4 MiB, whatever a file's size.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", only).option("recursiveFileLookup", "true").load(path).select("path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, name = store_of(file)
                rows: list[tuple] = []
                size = 0
                with store.open_input_stream(name, compression=None) as raw:
                    for n, (text, cut) in enumerate(lines_of(raw, name.endswith(".gz"))):
                        if text is None and not cut:
                            continue
                        rows.append((file, None if cut else n, text, cut))
                        size += len(text or "")
                        if size > BATCH_BYTES or len(rows) == 10_000:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return files.mapInArrow(read, LINES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def checked_records(spark: SparkSession, path: str, schema: str, only: str = "*.json*") -> DataFrame:
    """The columns of schema for every line of the files below path, and file, line, problem, text.

    problem: null for a record; 'line' for a line that is no object of the schema, whose text is kept and whose columns
    are null; 'end' for a file that breaks off, with neither line nor columns. A compressed file that is none at all has
    that row only; an empty file has no rows. A field that the line lacks is null, one that the schema lacks is ignored,
    and columns of the schema must not be called file, line, problem or text.
    """
    bad = "__bad"
    told = F.from_json("text", T.StructType.fromDDL(f"{schema}, {bad} string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    parsed = numbered_lines(spark, path, only).withColumn("r", told)
    broken = F.col(f"r.{bad}").isNotNull() | (~F.col("is_cut") & ~F.ltrim("text").startswith("{"))
    problem = F.when(F.col("is_cut"), "end").when(broken, "line")
    names = T.StructType.fromDDL(schema).fieldNames()
    return parsed.withColumn("problem", problem).select("file", "line", "problem", F.when(F.col("problem") == "line", F.col("text")).alias("text"), *[F.when(F.col("problem").isNull(), F.col(f"r.`{c}`")).alias(c) for c in names])


def problems(records: DataFrame) -> DataFrame:
    """Of each file: n_records, n_rejected, is_cut."""
    n = lambda keep: F.count(F.when(keep, True))
    return records.groupBy("file").agg(n(F.col("problem").isNull()).alias("n_records"), n(F.col("problem") == "line").alias("n_rejected"), (n(F.col("problem") == "end") > 0).alias("is_cut"))
