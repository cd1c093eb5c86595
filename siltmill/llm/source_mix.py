"""Mixing sources to target weights by systematic sampling.

Within a source the documents stand in one order; each expects target / source size copies; the running sum of these
expectations plus one random offset of the source emits a document once per integer boundary that it crosses.

The order is by size class, so that copies spread evenly over long and short documents and the words taken come near
the target. A source may hold a third of all rows: its order is cut into cells (size class and digest of the id),
counted first, and each cell is numbered on its own from where the cells before it end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmill.llm.tables import WORD, written

MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)


def text_size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def size_class(size: Column) -> Column:
    """Eight classes per power of two, by the four leading bits."""
    n = F.length(F.bin(size))
    high = F.when(size < 16, size).otherwise(n * 8 + F.floor(size / F.pow(F.lit(2.0), n - 4)) - 8).cast("long")
    return F.coalesce(high, F.lit(0).cast("long"))  # never null, so that joins on it need no filter that counts words again


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size -> the same with weight and target.

    Sources by code point, null last, weigh 1, 2, 3, repeating. A source is capped at MOST_REPEATS times its size
    and the excess goes to the others by weight: with the sources by size per weight, the capped ones come first, and
    one running sum finds where they end. One row per source; the windows hold these rows only.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1))
    full, words = F.col("source_size") * MOST_REPEATS, F.sum("source_size").over(every)
    left = words - F.coalesce(F.sum(full).over(before), F.lit(0))
    others = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    marked = weighed.withColumn("capped", full.cast("double") * others <= F.col("weight") * left.cast("double"))
    open_words = words - F.coalesce(F.sum(F.when(F.col("capped"), full)).over(every), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    share = open_words.cast("double") / open_weight * F.col("weight")
    return marked.withColumn("target", F.when(F.col("capped"), full.cast("double")).otherwise(share)).drop("capped")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", size_col: str | None = None) -> DataFrame:
    """docs with size, source_size, target, copies and taken = copies * size; columns of those names are replaced.

    No row is emitted more than MOST_REPEATS times. Null and empty texts have size 0; a null source is a source of
    its own; rows without an id count like others; equal rows may swap copies, which leaves the result as it is. An
    empty table gives an empty table. Reruns agree: all that is random comes from digests of the seed, the source and
    the ids (of the sizes, where there is no id). size_col names a column of sizes that have been counted before; then
    no text is read.
    """
    size = text_size(F.col(text_col)) if size_col is None else F.col(size_col)
    own = {"size": size, "__source": F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit(""))}
    sized = docs.drop("source_size", "target", "copies", "taken").withColumns(own)
    mark = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("size "), F.col("size").cast("string")))
    sized = sized.withColumn("__mark", F.md5(mark.cast("binary"))).withColumns({"__class": size_class(F.col("size")), "__salt": F.substring("__mark", 1, 2)})
    cell = ["__source", "__class", "__salt"]
    cells = written(sized.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n"), F.sum("size").alias("__words")), "cells")  # read twice
    sources = source_targets(
        cells.groupBy("__source").agg(F.sum("__words").alias("source_size")).select(F.when(F.col("__source") != "", F.substring("__source", 2, 1 << 30)).alias("source"), "source_size")
    ).select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("__source"), "source_size", "target")
    earlier = Window.partitionBy("__source").orderBy(F.col("__class").desc(), "__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(*cell, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start")).join(sources, "__source")
    place = F.row_number().over(Window.partitionBy(*cell).orderBy(F.col("size").desc(), "__mark", id_col)) + F.col("__start")
    each = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("__source")).cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    numbered = sized.join(starts, cell).withColumns({"__at": place, "__each": each, "__offset": offset})
    passed = F.floor(F.col("__at") * F.col("__each") + F.col("__offset")) - F.floor((F.col("__at") - 1) * F.col("__each") + F.col("__offset"))
    out = numbered.withColumn("copies", passed.cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
    return out.drop(*cell, "__mark", "__start", "__at", "__each", "__offset")


def emit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """The mixed corpus: every row as often as it is taken, with the columns of docs, whatever their names."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    mixed = mix(docs.select(id_col, text_col, source_col, whole), id_col, text_col, source_col, seed).filter(F.col("copies") > 0)
    return mixed.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("__row.*")
