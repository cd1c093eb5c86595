"""Paths of all files below the roots of directory trees."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltmill.functions.text import utf8_text
from siltmill.storage import written

#: Levels after which a walk first asks whether the folders form a circle.
TALL = 64


def folder_entries(raw: DataFrame) -> DataFrame:
    """directory_id, name (bytes), type, target -> parent, name, child, is_file, without what is neither a file nor a
    folder: submodules (type rev) and entries of no type."""
    return raw.filter("type <> 'rev'").select(F.col("directory_id").alias("parent"), utf8_text(F.col("name")).alias("name"), F.col("target").alias("child"), (F.col("type") == "file").alias("is_file"))


def walk(roots: DataFrame, entries: DataFrame, most_levels: int | None = None, most_per_node: int | None = None) -> DataFrame:
    """roots (node) and entries (parent, name, child, is_file) -> root, path, child, level of every file.

    One join per level; a level is written before the next reads it, and the walk ends when no folder is left. Folders
    that hold themselves have no end: a walk of more levels than there are folders raises. Both bounds are off unless
    given: most_levels ends the walk early, and nodes that more than most_per_node roots share in a level are followed
    from that many of them only, the smallest roots first.
    """
    entries = entries.select("parent", "name", "child", "is_file")
    front = roots.select(F.col("node").alias("root"), "node", F.lit("").alias("prefix"))
    files, folders = None, None
    for level in count():
        if level == most_levels:
            break
        if level == TALL:
            folders = entries.select("parent").distinct().count()
        if folders is not None and level > folders:
            raise ValueError("a folder holds itself; most_levels ends such a walk")
        if most_per_node is not None:
            rank = F.row_number().over(Window.partitionBy("node").orderBy("root", "prefix"))
            front = front.withColumn("__n", rank).filter(F.col("__n") <= most_per_node).drop("__n")
        met = front.join(entries, front["node"] == entries["parent"]).select("root", F.concat("prefix", F.lit("/"), "name").alias("path"), "child", "is_file")
        met = written(met, f"level-{level}")
        here = met.filter("is_file").select("root", "path", "child", F.lit(level).alias("level"))
        files = here if files is None else files.unionByName(here)
        front = met.filter("NOT is_file").select("root", F.col("child").alias("node"), F.col("path").alias("prefix"))
        if front.isEmpty():
            break
    return files


def with_content(files: DataFrame, content: DataFrame) -> DataFrame:
    """Files with their blob: child is the content's id."""
    return files.join(content.select(F.col("content_id").alias("child"), "blob_id", "length"), "child")


def unique_files(paths: DataFrame, digits: int = 2) -> DataFrame:
    """One row per content with the sorted set of its file names and a prefix of its blob's id to partition by."""
    names = paths.withColumn("filename", F.element_at(F.split("path", "/", -1), -1))
    one = names.groupBy("content_id", "blob_id", "length").agg(F.sort_array(F.collect_set("filename")).alias("filenames"))
    return one.withColumn("blob_prefix", F.substring("blob_id", 1, digits))
