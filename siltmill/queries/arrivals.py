"""What comes in over time and in part: damaged files, partitions of a job that stopped, events without a schema, histories that grow."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.operators import histories
from siltmill.queries import events as pulls
from siltmill.sources import json_lines, readers, resumed, sinks
from siltmill.sources.readers import table
from siltmill.storage import new_path
from siltmill.streaming import growing

QUERIES, ORACLE = {}, {}


def query(sql: str | None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _cut_gzip(whole: pd.Series, last: pd.Series, cut: pd.Series) -> pd.Series:
    """Compressed files; those to be cut stop behind half of their last line, without the end that a whole file has."""
    out = []
    for text, line, stops in zip(whole, last, cut, strict=True):
        packer = zlib.compressobj(wbits=31)
        raw = packer.compress((text + (line[: len(line) // 2] if stops else line + "\n")).encode())
        out.append(raw + packer.flush(zlib.Z_FULL_FLUSH if stops else zlib.Z_FINISH))
    return pd.Series(out, dtype=object)


def _damaged(spark: SparkSession, sf_dir: str) -> str:
    """A file for each hundred consecutive events: some lines are cut short, some are no JSON, every fourth file breaks off."""
    n = F.col("event_id")
    whole = F.to_json(F.struct("event_id", "user_id", "event_type"))
    line = F.when(n % 17 == 3, F.substring(whole, 1, 20)).when(n % 19 == 4, F.lit("no record")).when(n % 23 == 5, F.lit("  ")).otherwise(whole)
    files = table(spark, sf_dir, "events").groupBy(F.floor(n / 100).alias("k")).agg(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))).alias("x"))
    lines = F.transform("x", lambda x: x["line"])
    first = F.array_join(F.transform(F.slice(lines, F.lit(1), F.size(lines) - 1), lambda x: F.concat(x, F.lit("\n"))), "")
    raw = F.pandas_udf(_cut_gzip, "binary")(first, F.element_at(lines, -1), F.col("k") % 4 == 1)
    path = new_path(spark, "damaged")
    sinks.blobs(files.select(F.format_string("f%012d", "k").alias("id"), raw.alias("raw")), path, "id", "raw", packed=True)
    return path


_DAMAGED = """
WITH e AS (SELECT event_id // 100 AS k, event_id, event_id % 17 = 3 OR event_id % 19 = 4 AS bad, event_id % 23 = 5 AND event_id % 17 <> 3 AND event_id % 19 <> 4 AS blank,
    event_id = max(event_id) OVER (PARTITION BY event_id // 100) AND event_id // 100 % 4 = 1 AS cut, user_id, event_type FROM events)"""


@query(f"""{_DAMAGED}
SELECT printf('f%012d', k) AS file, count(*) FILTER (NOT bad AND NOT blank AND NOT cut) AS n_records, count(*) FILTER (bad OR cut AND NOT blank) AS n_rejected, k % 4 = 1 AS is_cut FROM e GROUP BY k""")
def damaged_file_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each file how many lines are records, how many are not, and whether it breaks off."""
    records = json_lines.checked_records(spark, _damaged(spark, sf_dir), "event_id long, user_id long, event_type string", only="*.gz")
    return json_lines.problems(records).withColumn("file", F.regexp_extract("file", r"([^/]+)\.gz$", 1))


_GOOD = f"{_DAMAGED} SELECT event_id, user_id, event_type FROM e WHERE NOT bad AND NOT blank AND NOT cut"


@query(_GOOD)
def damaged_file_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = json_lines.checked_records(spark, _damaged(spark, sf_dir), "event_id long, user_id long, event_type string", only="*.gz")
    return records.filter("problem IS NULL").select("event_id", "user_id", "event_type")


@query(_GOOD)
def tolerant_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files by Spark's own reader, which drops what it cannot read without a word."""
    return readers.json_records(spark, _damaged(spark, sf_dir), "event_id long, user_id long, event_type string", only="*.gz").filter("event_id IS NOT NULL")


@query("SELECT lang, source, doc_id, n_chars, CASE WHEN lang <= (SELECT list_sort(list(DISTINCT lang))[2] FROM documents) THEN 1 ELSE 2 END AS run FROM documents")
def resumed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language, by a run that ends behind two languages and one that goes on; each row with the run whose
    file holds it, which for the first two is still the first."""
    path = new_path(spark, "resumed")
    docs = table(spark, sf_dir, "documents").select("lang", "source", "doc_id", "n_chars")
    resumed.write_partitions(docs, path, "lang", at_once=1, most=2)
    earlier = spark.read.schema(docs.schema).parquet(path).select(F.col("_metadata.file_name").alias("file")).distinct()
    seen = earlier.select("file", F.lit(1).alias("run"))
    resumed.write_partitions(docs, path, "lang", at_once=2)
    rows = spark.read.schema(docs.schema).parquet(path).select(*docs.columns, F.col("_metadata.file_name").alias("file"))
    return rows.join(seen, "file", "left").select(*docs.columns, F.coalesce("run", F.lit(2)).alias("run"))


@query(pulls.ORACLE["flat_pull_events"])
def variant_pull_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as JSON lines, each a variant, read field by field."""
    raw = pulls.pull_events(spark, sf_dir)
    lines = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    return pulls.shown_events(histories.flat_events(histories.variant_events(lines)))


@query("""
SELECT conv_id, CASE WHEN conv_id % 5 = 1 THEN 0 ELSE count(*) END AS n_events, CASE WHEN conv_id % 5 <> 1 THEN string_agg(role, ' ' ORDER BY turn) ELSE '' END AS roles,
  CASE WHEN conv_id % 5 = 1 THEN 0 ELSE count(*) FILTER (turn % 3 = 1) END AS n_extra FROM conversations GROUP BY conv_id""")
def listed_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lists as JSON: null ones, lists cut short and objects in place of one are empty; a field of other shapes in
    each third event is read where it is there."""
    extra = F.when(F.col("turn") % 3 == 1, F.struct(F.array(F.struct(F.col("turn").alias("n"))).alias("deep")))
    lists = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("turn", "role", extra.alias("extra"))))).alias("events"))
    k = F.col("conv_id")
    told = F.when(k % 5 > 1, F.col("events")).when(k % 5 == 0, F.concat(F.lit(" "), "events")).when(k % 15 == 1, F.lit('{"turn": 1}')).when(k % 15 == 6, F.substring("events", 1, 9))
    events = lists.select("conv_id", histories.listed_events(told).alias("e"))
    role, deep = (lambda x: F.try_variant_get(x, "$.role", "string")), (lambda x: F.try_variant_get(x, "$.extra.deep[0].n", "bigint"))
    return events.select("conv_id", F.size("e").cast("long").alias("n_events"), F.array_join(F.transform("e", role), " ").alias("roles"), F.size(F.filter("e", lambda x: deep(x).isNotNull())).cast("long").alias("n_extra"))


@query(pulls.ORACLE["pull_statistics"])
def growing_pull_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of histories that a stream of events built, batch by batch."""
    flat = histories.routed(histories.flat_events(pulls.pull_events(spark, sf_dir)))[1]
    out = new_path(spark, "histories")
    growing.followed(growing.stream_of(flat), out, new_path(spark, "state"))
    return histories.with_stats(growing.pull_histories(spark.read.parquet(out), flat)).drop("events")


@query("SELECT event_id, CASE WHEN event_id % 7 < 2 THEN NULL ELSE ts END AS ts FROM events")
def out_of_range_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORC times before the year 1 and after the year 9999 become null."""
    path = new_path(spark, "times")
    n = F.col("event_id") % 7
    far = F.timestamp_seconds(F.when(n == 0, F.lit(300_000_000_000)).otherwise(F.lit(-70_000_000_000)) + F.col("event_id"))
    table(spark, sf_dir, "events").select("event_id", F.when(n < 2, far).otherwise(F.col("ts").cast("timestamp")).alias("ts")).write.orc(path)
    return readers.orc_with_timestamps(spark, path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
