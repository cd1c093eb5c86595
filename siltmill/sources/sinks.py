"""Tables to files."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltmill.storage import store_of, written

SHARD_BYTES = 1000 << 20


def parquet(df: DataFrame, path: str, files: int | None = None, by: list[str] | None = None) -> None:
    """Snappy Parquet over what is there, in so many files; by: folders by column values, each of so many files at most
    while their rows are few, and of more where a task would get more than the session's advisory size."""
    dealt = df if not files else df.hint("rebalance", files) if by else df.repartition(files)
    out = dealt.write.mode("overwrite").option("compression", "snappy")
    (out.partitionBy(*by) if by else out).parquet(path)


def gzip_json(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    out = df.write.mode("overwrite").option("compression", "gzip")
    (out.partitionBy(*by) if by else out).json(path)


def csv(df: DataFrame, path: str) -> None:
    """With a header; quotes double, and white space at either end of a value stays."""
    out = df.write.mode("overwrite").option("header", "true").option("escape", '"')
    out.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def sharded(df: DataFrame, path: str, text: str, shard_bytes: int = SHARD_BYTES) -> int:
    """Parquet in files of about shard_bytes of text each; returns their number."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = int(size // shard_bytes) + 1
    parquet(df, path, n)
    return n


def blobs(df: DataFrame, path: str, id_col: str, raw_col: str, packed: bool = False) -> int:
    """One compressed file per row below path, named by its id, written where the rows are; returns their number. packed:
    the contents are compressed as they come. Null ids and contents are left out. A task that runs again writes the same files again; of rows that share an id one is
    kept, whichever is written last."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = store_of(path)
        store.create_dir(folder, recursive=True)
        for batch in batches:
            for blob_id, raw in zip(batch[id_col], batch[raw_col], strict=True):
                with store.open_output_stream(f"{folder}/{blob_id}.gz", compression=None) as file:
                    file.write(raw if packed else gzip.compress(raw, mtime=0))
            yield pd.DataFrame({"n": [len(batch)]})

    rows = df.select(id_col, raw_col).dropna()
    return rows.mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0


def contiguous(df: DataFrame, path: str, size: str, shard_bytes: int = SHARD_BYTES, order: list[str] | None = None, prefix: str = "train") -> int:
    """Parquet in shards of consecutive rows and equal bytes; returns their number, total // shard_bytes + 1.

    size: an SQL expression of a row's bytes (null: 0). Rows go by order, or else in the order Spark reads them (Spark
    packs files by size, so of several files only the rows within each keep theirs). Shard
    k of n holds the rows that begin in the k-th of n equal parts of all bytes, so it differs from that part by less than
    one row; it is the one file below shard=PREFIX-0000k-of-0000n, its rows in order. A shard without a row (one row
    larger than a part) has no file; an empty table has none at all, yet its number is 1.

    Running sums are taken within the partitions the rows came in, and only one total a partition is summed across them.
    Rows meet their shard by partition, through an array of the few shards that begin in it, and are shuffled once.
    """
    ordered = (df.orderBy(*order) if order else df).withColumns({"__row": F.monotonically_increasing_id(), "__size": F.coalesce(F.expr(size).cast("long"), F.lit(0))})
    rows = written(ordered.withColumn("__part", F.shiftright("__row", 33)), "contiguous")  # numbers hold however tasks are rerun
    totals = rows.groupBy("__part").agg(F.sum("__size").alias("bytes"))
    before = totals.withColumn("before", F.coalesce(F.sum("bytes").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    total = totals.agg(F.sum("bytes")).first()[0] or 0
    n = int(total // shard_bytes) + 1
    within = F.sum("__size").over(Window.partitionBy("__part").orderBy("__row").rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.select("__part", "__row", F.coalesce(within, F.lit(0)).alias("start")).join(before.select("__part", "before"), "__part")
    shard = F.least(F.expr(f"(start + before) * {n}BD div {max(total, 1)}BD"), F.lit(n - 1)).cast("int")
    cuts = starts.select("__part", "__row", shard.alias("shard")).groupBy("__part", "shard").agg(F.min("__row").alias("first"))
    listed = cuts.groupBy("__part").agg(F.array_sort(F.collect_list(F.struct("first", "shard"))).alias("__cuts"))
    last = F.array_max(F.filter("__cuts", lambda c: c["first"] <= F.col("__row")))["shard"]
    placed = rows.join(listed, "__part").withColumn("__shard", last)
    name = F.format_string(f"{prefix}-%05d-of-{n:05d}", "__shard")
    dealt = placed.repartition(n, "__shard").withColumn("shard", name).sortWithinPartitions("shard", "__row")  # the order that writing by shard asks for, so that it stays
    dealt.drop("__row", "__size", "__part", "__cuts", "__shard").write.mode("overwrite").option("compression", "snappy").partitionBy("shard").parquet(path)
    return n


def unfinished(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose key has no output yet, so that a job that stopped goes on where it was."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")
