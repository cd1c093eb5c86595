"""Tables from event archives, columnar stores, text collections and blob folders."""

from __future__ import annotations

import gzip
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltmill.storage import store_of

# A fixed format: a repository as events describe it.
_REPO = (
    "struct<id: bigint, full_name: string, html_url: string, mirror_url: string, default_branch: string, description: string, fork: boolean, created_at: timestamp, updated_at: timestamp, pushed_at: timestamp, "
    "homepage: string, size: bigint, stargazers_count: int, forks_count: int, open_issues_count: int, language: string, has_issues: boolean, has_projects: boolean, has_downloads: boolean, has_wiki: boolean, "
    "has_pages: boolean, has_discussions: boolean, archived: boolean, disabled: boolean, license: struct<key: string, name: string, spdx_id: string, url: string, node_id: string>>"
)
EVENTS = f"type string, created_at timestamp, repo struct<id: bigint, name: string>, payload struct<pull_request: struct<base: struct<repo: {_REPO}>>, forkee: {_REPO}>"
CONTENTS = "blob_id string, content_id string, length bigint, filenames array<string>, content string, src_encoding string, language string, is_vendor boolean, is_generated boolean, licenses array<string>"
# End of the format.
MOST_BLOB = 10 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def json_records(spark: SparkSession, path: str, schema: str, only: str = "*.json*") -> DataFrame:
    """JSON lines, compressed or not, of the columns in schema only. Malformed lines and broken files are left out."""
    records = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("ignoreCorruptFiles", "true").option("pathGlobFilter", only).json(path)
    return records.select(*T.StructType.fromDDL(schema).fieldNames())  # folders by value would add columns


def orc_with_timestamps(spark: SparkSession, path: str) -> DataFrame:
    """ORC files whose timestamps may be out of range: times before the year 1 or after the year 9999, which most
    other readers refuse, become null."""
    found = spark.read.orc(path)
    times = [f.name for f in found.schema.fields if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)]
    return found.withColumns({c: F.when(F.year(c).between(1, 9999), F.col(c)) for c in times})


def file_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of files to fetch, with nulls for what is not known yet, without those of 10 MiB or more."""
    return json_records(spark, path, CONTENTS).filter(F.col("length") < MOST_BLOB)


def _text_of(raw: bytes | None) -> str | None:
    try:
        data = gzip.decompress(raw)
    except Exception:
        return None
    return None if b"\0" in data else data.decode("utf-8", "replace")


def blobs(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """records with content from one compressed file per blob id below path; null where it is missing, broken or
    binary. Fetching runs where the files are read, and only contents that are wanted are unpacked."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    named = files.select(F.regexp_extract("path", r"([^/]+)\.gz$", 1).alias("blob_id"), F.col("content").alias("raw"))
    wanted = named.join(records.select("blob_id").distinct(), "blob_id", "left_semi")

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"blob_id": batch["blob_id"], "content": [_text_of(x) for x in batch["raw"]]})

    return records.drop("content").join(wanted.mapInPandas(unpack, "blob_id string, content string").hint("merge"), "blob_id", "left")


def stored(path: str) -> Callable[[str], bytes | None]:
    """Reads one blob below path by its id, from any store that pyarrow opens; None where there is none."""

    def fetch(blob_id: str) -> bytes | None:
        store, folder = store_of(path)
        try:
            with store.open_input_stream(f"{folder}/{blob_id}.gz", compression=None) as file:
                return file.read()
        except FileNotFoundError:
            return None

    return fetch


def fetched_blobs(records: DataFrame, fetch: Callable[[str], bytes | None], at_once: int = 16) -> DataFrame:
    """records with the content of the blobs they name and no other blob listed or opened: the ids are dealt to tasks,
    each of which reads its own, so many at once. An id that several records share is read once.

    Null where the blob is missing, broken or binary, or the id null. Memory: a batch's blobs, of MOST_BLOB at most if
    records are those of file_records. Contents are joined back by id, and by sorting: Spark knows the ids' size alone and
    would send the contents through the driver, and read few bytes of ids in few tasks.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(at_once) as pool:
            for batch in batches:
                for first in range(0, len(batch), at_once):
                    ids = batch["blob_id"].iloc[first : first + at_once]
                    yield pd.DataFrame({"blob_id": ids, "content": [None if raw is None else _text_of(raw) for raw in pool.map(fetch, ids)]})

    tasks = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = records.select("blob_id").filter("blob_id IS NOT NULL").distinct().repartition(tasks)
    return records.drop("content").join(ids.mapInPandas(read, "blob_id string, content string").hint("merge"), "blob_id", "left")


def notebooks(spark: SparkSession, path: str, only: str = "*.ipynb") -> DataFrame:
    """file_id, content (JSON list of cells), local_path of the files named so; those that are no notebooks are left out."""
    raw = spark.read.text(path, wholetext=True, pathGlobFilter=only, recursiveFileLookup=True).withColumn("local_path", F.col("_metadata.file_path"))
    return raw.select(F.regexp_extract("local_path", r"([^/]+)\.[^./]+$", 1).alias("file_id"), F.get_json_object("value", "$.cells").alias("content"), "local_path").filter("content IS NOT NULL")


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)


def alternate_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, n, content: lines 2n and 2n + 1 of each text file as one; an odd line at the end is left out."""
    raw = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = F.split(F.regexp_replace("value", "\n\\z", ""), "\n", -1)
    pairs = F.transform(F.sequence(F.lit(1), F.floor(F.size(lines) / 2).cast("int")), lambda k: F.concat(F.element_at(lines, 2 * k - 1), F.lit("\n"), F.element_at(lines, 2 * k)))
    return raw.filter(F.size(lines) > 1).select("file", F.posexplode(pairs).alias("n", "content"))


def query_responses(spark: SparkSession, path: str) -> DataFrame:
    return json_records(spark, path, "query string, response string").select(F.concat_ws("\n", "query", "response").alias("content"))


def with_stem(df: DataFrame, columns: list[str], name: str = "stem") -> DataFrame:
    """Some columns of a file table and the name of the file a row is from, without its extension."""
    return df.select(*columns, F.regexp_extract("_metadata.file_name", r"^(.*?)(\.[^.]*)?$", 1).alias(name))


def archive_grid(spark: SparkSession, first: str, last: str) -> DataFrame:
    """day, hour, name of the hourly archive files from first to last day, both included; hours are not padded."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("day"))
    return days.select("day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")).withColumn("name", F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("-"), F.col("hour").cast("string"), F.lit(".json.gz")))


def missing(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """What a manifest lists and a store does not have yet."""
    return wanted.join(present.select(*keys).distinct(), keys, "left_anti")
