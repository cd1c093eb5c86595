"""From groups that may hold links to link counts and components, without a list of pairs.

Rows with equal content form a class; the operators link classes. Classes meet in the nodes of several tables (trees,
hash tables); a pair that meets in several counts in the first of these only, which both classes' nodes tell. A node is
cut into blocks of bounded size and every pair of blocks is one task's unit of work, so a node of any size is compared
whole, by many tasks. A unit reports, per class, the documents it links and the smallest class it reaches: never the
pairs. Components are taken of what was found to link, never of what merely met.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.llm.tables import written

#: Classes in a block; a unit compares two blocks at most.
BLOCK = 128


def numbered(classes: DataFrame) -> DataFrame:
    """classes as a table with a number of each in `no`."""
    return written(classes.withColumn("no", F.monotonically_increasing_id()), "classes")


def meetings(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """members (no, table, node; nodes are of one table each) -> the groups to compare (no, table, node, n) and the
    leaders (no, leader) of those that meet others.

    A class's leader is the smallest number that it meets in any node. Those of one leader are a group, as table 0, so
    a tight cluster is compared once, not once in each of its nodes. What is left are nodes of several leaders, for the
    pairs of different ones; of nodes with the same members that of the first table stays.
    """
    nodes = members.groupBy("node").agg(F.min("no").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("node", "low")
    led = members.join(nodes.repartition("node", "low"), "node").groupBy("no").agg(F.min("low").alias("leader"))  # see components()
    led = written(led, "leaders")
    sizes = led.groupBy("leader").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = led.join(sizes.repartition("leader", "n"), "leader").select("no", F.lit(0).alias("table"), F.xxhash64(F.lit("leader"), "leader").alias("node"), "n")
    marks = [F.bit_xor(F.xxhash64("no")).alias("x"), F.bit_xor(F.xxhash64("no", F.lit(1))).alias("y")]
    rows = members.join(led, "no")
    mixed = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *marks, F.min("table").alias("table"), F.min("leader").alias("low"), F.max("leader").alias("high")).filter("low < high")
    one = mixed.groupBy("n", "x", "y").agg(F.min_by("node", "table").alias("node")).select("node", "n")
    rest = members.join(one.repartition("node", "n"), "node").select("no", (F.col("table") + 1).alias("table"), "node", "n")
    return first.unionByName(rest), led


def met_first(leaders: np.ndarray, marks: np.ndarray, table: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b) that meet in a table of meetings() share neither a leader, unless that is the table,
    nor a node of an earlier table; marks has a row per class and a column per table."""
    if table == 0:
        return np.ones(len(a), bool)
    first = leaders[a] != leaders[b]
    rest = np.flatnonzero(first)
    first[rest] = (marks[a[rest], : table - 1] != marks[b[rest], : table - 1]).all(axis=1)
    return first


def in_blocks(members: DataFrame, size: Column, key: Column, block: int = BLOCK) -> DataFrame:
    """members once per unit of its group: unit_i <= unit_j are the unit's blocks, own is the member's block."""
    n = F.ceil(size / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(key), n.cast("long")).cast("int")
    other = members.withColumn("__n", n).withColumn("own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    return other.withColumns({"unit_i": F.least("own", "__other"), "unit_j": F.greatest("own", "__other")}).drop("__n", "__other")


def units(batches: Iterator[pd.DataFrame], by: Sequence[str], key: str, read: Callable) -> Iterator[tuple[tuple, list]]:
    """Runs of rows with equal `by` in sorted batches, which may span batches: of each key what read(row) makes of its
    first row that it makes anything of. Repeated rows are passed over as they come, so a run is as large as its keys
    are many."""
    now, items = None, {}
    for batch in batches:
        for mark, own, row in zip(zip(*(batch[c].tolist() for c in by)), batch[key], batch.itertuples(index=False)):
            if mark != now:
                if items:
                    yield now, list(items.values())
                now, items = mark, {}
            if own not in items and (item := read(row)) is not None:
                items[own] = item
    if items:
        yield now, list(items.values())


def reach(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches by the edges (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


REPORT = "no long, links long, root long"


def unit_report(numbers: np.ndarray, copies: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """REPORT of a unit's linked classes, which stand by number; (a, b) are its links."""
    links = np.bincount(a, copies[b], len(numbers)) + np.bincount(b, copies[a], len(numbers))
    root = reach(len(numbers), a, b)
    hit = np.flatnonzero(links)
    return pd.DataFrame({"no": numbers[hit], "links": links[hit].astype(np.int64), "root": numbers[root[hit]]})


def components(edges: DataFrame) -> DataFrame:
    """id, root: the smallest id reachable from each id that is not a root itself; edges has the columns id, root.

    Alternating large-star and small-star steps: each step sends ids to the smallest neighbour, by partial minima and
    joins. Every round is written to the shared folder and the loop ends when a round changes nothing.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("id", "root"))).first())

    e = written(edges.filter("id <> root").select(F.greatest("id", "root").alias("id"), F.least("id", "root").alias("root")).distinct(), "edges", narrow=True)
    was = state(e)
    while was[0]:
        # The minima are dealt anew before they are joined back: then both sides of the join are shuffled for it alone,
        # and Spark splits the partition of an id with very many neighbours.
        both = e.unionByName(e.select(F.col("root").alias("id"), F.col("id").alias("root")))
        low = both.groupBy("id").agg(F.min("root").alias("low")).withColumn("low", F.least("low", "id")).repartition("id", "low")
        large = both.join(low, "id").filter("root > id").select(F.col("root").alias("id"), F.col("low").alias("root")).distinct()
        low = large.groupBy("id").agg(F.min("root").alias("low")).repartition("id", "low")
        small = large.join(low, "id").select(F.when(F.col("root") == F.col("low"), F.col("id")).otherwise(F.col("root")).alias("id"), F.col("low").alias("root"))
        e = written(small.filter("id <> root").distinct(), "edges", narrow=True)
        now = state(e)
        if now == was:
            break
        was = now
    return e


def resolve(rows: DataFrame, classes: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """id, component_id (smallest id of the component), copies (rows of equal content), n_links, kept, of every row.

    rows: id, key (null: links with nothing); classes: no, key, rep (smallest id), copies; found: reports of the units.
    A row without an id or key is alone: no links, its own component, kept.
    """
    roots = components(found.select(F.col("no").alias("id"), "root")).withColumnsRenamed({"id": "no", "root": "to"})
    links = found.groupBy("no").agg(F.sum("links").alias("links"))
    known = classes.join(links, "no", "left").join(roots, "no", "left").withColumn("to", F.coalesce("to", "no"))
    heads = known.groupBy("to").agg(F.min("rep").alias("component_id")).repartition("to", "component_id")  # see components()
    info = known.join(heads, "to").select("key", "component_id", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    alone = F.col("component_id").isNull()
    return rows.select(id_col, "key").join(info, "key", "left").select(
        id_col,
        F.coalesce("component_id", F.col(id_col)).alias("component_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | (F.col(id_col) == F.col("component_id"))).alias("kept"),
    )
