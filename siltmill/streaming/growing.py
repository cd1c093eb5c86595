"""Histories of pull requests that grow as their events arrive: per pull request a list of events in keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from siltmill.operators.histories import pull_order, told_pulls
from siltmill.storage import new_path

IDLE = 30 * 24 * 3600
# Keyed lists need this store; and timers of processing time would ask for one more batch without data for ever, so that
# a run over what is there would not end: they fire with the batches that bring events.
SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
PARTS = "group_id string, part long, events array<string>"


class _Growing(StatefulProcessor):
    """Appends a key's new events to its list and emits the list; ends the part of a key that has been idle.

    Each call to the state is a message to the JVM, so a key has one timer, set anew only when it fires too early; when
    events came last stands beside the part's number, null between parts."""

    def __init__(self, idle: int) -> None:
        self.idle = idle * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", "event string")
        self.part = handle.getValueState("part", "part long, last long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        part, last = self.part.get() or (0, None)
        before = [] if last is None else [e[0] for e in self.events.get()]
        new = [row["event"] for row in rows]
        self.events.appendList([(e,) for e in new])
        now = timerValues.getCurrentProcessingTimeInMs()
        if last is None:
            self.handle.registerTimer(now + self.idle)
        self.part.update((part, now))
        yield Row(group_id=key[0], part=part, events=before + new)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        part, last = self.part.get()
        if last + self.idle > timerValues.getCurrentProcessingTimeInMs():
            self.handle.registerTimer(last + self.idle)
        else:
            self.part.update((part + 1, None))
            self.events.clear()
        return iter(())

    def close(self) -> None:
        return


def growing(events: DataFrame, idle: int = IDLE) -> DataFrame:
    """group_id, part, events of each pull request that a batch of a stream of flat events touches: all events of the
    part so far, as JSON with what they are ordered by.

    Appending costs what is new, whatever a history's length; the emitted row costs what the part holds. A pull request
    without events for `idle` seconds (by a timer) ends its part: its state is cleared but for the part's number, and
    events that come later begin the next part, so state is that of the pull requests in motion and no event is late.
    Rows of a null group are one group, as in the table. Memory: a task holds one part of one pull request.
    """
    at, kind, seq = pull_order(events)
    event = F.struct(at.alias("at"), kind.alias("kind"), seq.alias("seq"), F.struct(*[c for c in events.columns if c != "group_id"]).alias("event"))
    keyed = events.select("group_id", F.to_json(event).alias("event"))
    return keyed.groupBy("group_id").transformWithState(_Growing(idle), T.StructType.fromDDL(PARTS), "Update", "ProcessingTime")


def followed(events: DataFrame, out: str, state: str, idle: int = IDLE) -> None:
    """Runs growing() over what the stream's source has now, adding to the table out; state is the stream's own folder.
    Both are kept between runs, so a later run goes on where this one was; a batch that is run again is told by its number."""
    spark = events.sparkSession
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:

        def keep(batch: DataFrame, n: int) -> None:
            batch.withColumn("batch", F.lit(n).cast("long")).write.mode("append").parquet(out)

        growing(events, idle).writeStream.outputMode("update").option("checkpointLocation", state).foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def pull_histories(parts: DataFrame, events: DataFrame) -> DataFrame:
    """What histories.pull_histories gives of the table of all events, from the parts that followed() wrote: of each part
    the last row, the parts of a pull request put together. events: any table of the stream's columns."""
    rest = [f for f in events.schema.fields if f.name != "group_id"]
    kind = T.StructType([T.StructField("at", events.schema["created_at"].dataType), T.StructField("kind", T.BooleanType()), T.StructField("seq", T.LongType()), T.StructField("event", T.StructType(rest))])
    last = parts.groupBy("group_id", "part").agg(F.max_by("events", "batch").alias("events"))
    whole = last.groupBy("group_id").agg(F.flatten(F.collect_list("events")).alias("events"))
    ordered = F.array_sort(F.transform("events", lambda e: F.from_json(e, kind)))
    return told_pulls(whole.select("group_id", F.transform(ordered, lambda x: x["event"]).alias("events")))


def stream_of(events: DataFrame, files: int = 8, per_batch: int = 3) -> DataFrame:
    """A table as a stream of its files, so many a batch, the way an archive's files come in."""
    path = new_path(events.sparkSession, "arriving")
    events.repartition(files).write.parquet(path)
    return events.sparkSession.readStream.schema(events.schema).option("maxFilesPerTrigger", per_batch).parquet(path)
