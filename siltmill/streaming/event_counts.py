"""Event counts per window and type, over a stream or a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltmill.storage import new_path


def windowed(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """event_type, start of the window, n_events, value: events that come later than `late` after newer ones are left
    out of a stream's counts; a table has no late ones. Sums are exact to a ten-thousandth."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    counted = timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").cast("decimal(18,4)")).alias("v"))
    return counted.select("event_type", F.col("w.start").cast("timestamp_ntz").alias("start"), "n_events", F.col("v").cast("double").alias("value"))


def drained(stream: DataFrame) -> DataFrame:
    """The whole result of an aggregating stream over what its source has now, the open windows included."""
    spark = stream.sparkSession
    out, state = new_path(spark, "stream"), new_path(spark, "state")

    def keep(batch: DataFrame, n: int) -> None:
        batch.withColumn("__n", F.lit(n)).write.mode("append").parquet(out)

    query = stream.writeStream.outputMode("update").option("checkpointLocation", state).foreachBatch(keep).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.parquet(out)
    keys = [c for c in stream.columns if c in ("event_type", "start")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in stream.columns if c not in keys]), "__n").alias("r"))
    return last.select(*keys, "r.*")
