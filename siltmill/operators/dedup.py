"""One row per key by priority, caps per key, deterministic samples and slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmill.storage import written


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], most: int = 1) -> DataFrame:
    """The first rows of each key. order must end in what is unique, or ties fall as they may.

    Spark plans a small `most` as a limit before and after the shuffle, so a hot key sends few rows.
    """
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("__n") <= most).drop("__n")


def uniform(*key: Column) -> Column:
    """A number in [0, 1) by the key's SHA-256: a sample that reruns and other engines repeat."""
    text = F.concat_ws("|", *[k.cast("string") for k in key])
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double") / float(1 << 32)


def repo_rate(n: Column) -> Column:
    """The part of a repository's pull requests to keep: falls with their number, then leaves about a hundred."""
    return F.when(n <= 1000, F.lit(0.8007) - F.lit(0.0007) * n).otherwise(F.lit(100.0) / n)


def slice_of(df: DataFrame, order: Sequence[str], part: int, parts: int) -> DataFrame:
    """The part-th of `parts` contiguous slices by the order; the last takes the rest.

    Ranks come from range partitions and their counts, so no task holds all rows.
    """
    ranked = with_rank(df, order)
    size = F.floor(F.col("__total") / parts)
    last = F.lit(part == parts - 1)
    return ranked.filter((F.col("__rank") >= size * part) & (last | (F.col("__rank") < size * (part + 1)))).drop("__rank", "__total")


def with_rank(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """df with __rank, from 0 in the given order, and __total.

    Rows are dealt into ranges of the order and written; a range's ranks start where the ranges before it end, so
    that each task numbers its own range only.
    """
    dealt = written(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"), F.sum("__n").over(all_rows).alias("__total"))
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    # one row per range, of which there are as many as shuffle partitions
    return dealt.join(F.broadcast(starts), "__range").withColumn("__rank", own + F.col("__start")).drop("__range", "__start")


def with_previous(df: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """key, order and, under `name`, the order value of the row before it among those of equal key; a key's first row
    goes. Rows meet their neighbours by rank, so a key with a third of all rows is no single task's; whatever else
    belongs to the two rows is joined to their order values, which must be unique."""
    ranked = with_rank(df.select(key, order), [key, order])
    before = ranked.select((F.col("__rank") + 1).alias("__rank"), F.col(key).alias("__key"), F.col(order).alias(name))
    return ranked.join(before, "__rank").filter(F.col(key).eqNullSafe(F.col("__key"))).select(key, order, name)


def with_group_size(df: DataFrame, key: str, name: str) -> DataFrame:
    """df with the number of rows that share its key, nulls too: counted before it is joined back, so that a key with
    a third of all rows is no single task's."""
    sizes = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias(name))
    return df.join(sizes, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")


def round_robin(df: DataFrame, order: Sequence[str], parts: int) -> DataFrame:
    """df with the column part: rows dealt in turn by the order."""
    return with_rank(df, order).withColumn("part", F.pmod("__rank", F.lit(parts))).drop("__rank", "__total")
