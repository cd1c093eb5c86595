"""Sharding by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table (offset + j * skip). The shards take turns;
each claims the first free slot of its permutation, until the table is full. A key's digest picks a slot and the slot
names the shard: one lookup in a broadcast table, and few keys move when a shard comes or goes.

The rows are placed with DataFrame functions only. The table itself, of a size fixed by its parameter, is filled in
the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:02d}" for i in range(32))
SLOTS = 3203  # a prime of about a hundred slots a shard: shards differ by about one slot
#: Slot tables up to this size are broadcast; their bytes are a few tens per slot.
MOST_SLOTS = 1_000_003


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[str]:
    """The shard of each slot. Shards with equal names are one shard; their order does not matter."""
    names = sorted(set(shards))
    if not names or not 2 <= slots <= MOST_SLOTS or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("fill() takes at least one shard and a prime number of slots within MOST_SLOTS")
    offset = [_digest(f"offset:{n}") % slots for n in names]
    skip = [_digest(f"skip:{n}") % (slots - 1) + 1 for n in names]
    owner: list[str | None] = [None] * slots
    left = slots
    while left:
        for i, name in enumerate(names):
            while owner[offset[i]] is not None:
                offset[i] = (offset[i] + skip[i]) % slots
            owner[offset[i]] = name
            left -= 1
            if not left:
                break
    return owner


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """slot int, shard string: one row per slot."""
    owner = fill(shards, slots)
    names = sorted(set(owner))
    places = ",".join(str(names.index(x)) for x in owner)
    return spark.range(1).select(F.posexplode(F.split(F.lit(places), ",")).alias("slot", "n")).select("slot", F.element_at(F.array(*map(F.lit, names)), F.col("n").cast("int") + 1).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """60 bits of the key's MD5, modulo the slots; a null key counts as the empty string."""
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(slots).cast("long")).cast("int")


def place(df: DataFrame, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS, slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """df with its slot and shard, which replace columns of those names. Nothing is shuffled: the lookup table has
    `slots` rows whatever the input and is broadcast. Rows with equal keys, nulls included, share a shard; an empty table
    gives an empty table."""
    table = lookup_table(df.sparkSession, shards, slots).select(F.col("slot").alias("__slot"), F.col("shard").alias("__shard"))
    keyed = df.withColumn("__at", slot_of(F.col(key), slots)).drop(slot_col, shard_col)
    return keyed.join(F.broadcast(table), F.col("__at") == F.col("__slot"), "left").withColumnsRenamed({"__at": slot_col, "__shard": shard_col}).drop("__slot")


def write_shards(df: DataFrame, path: str, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS, files: int = 1) -> None:
    """One folder per shard. Each shard is dealt to `files` tasks by a random-free salt of whole rows, so that a key
    with a third of all rows is no single task's."""
    placed = place(df, key, shards, slots)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, kind in placed.dtypes if "map<" not in kind]), F.lit(files))
    placed.repartition(max(1, len(set(shards)) * files), "shard", salt).write.partitionBy("shard").parquet(path)
