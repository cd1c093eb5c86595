"""N-gram Jaccard join by a MinHash LSH forest.

Each document is a set of five-word shingles. A tree of the forest is a trie over labels, a label being a sequence of
minima under the tree's own permutations; documents meet where they stand below one trie node, that is, share a prefix
of their labels. The shorter the prefix, the likelier a pair of some similarity meets, and the fuller the nodes.
A node is named by the hash of its tree, depth and prefix, so the documents below it are those of equal names; they
need not be sorted to stand together, and a full node is no single task's run.

Every document starts from its longest prefixes, in the trees where it has company at the shortest. It shortens one
prefix a level at a time, in the least crowded tree first, until its trees together reach the target recall for a pair
at the threshold. So crowds (documents alike without being near-duplicates) are told apart by long prefixes.

What meets below a node is compared there by exact intersection of the shingle sets, every pair once: those that meet
the same smallest class in one group, others in the first tree in which they meet. Components are taken of the verified
links. Documents with equal shingle sets are one class throughout.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.llm import links
from siltmill.llm.tables import WORD, written
from siltmill.operators.dedup import first_by

WIDTH = 5  # words of a shingle
THRESHOLD = (4, 5)  # Jaccard similarity, as a fraction of integers
TREES, LONGEST = 24, 8  # tries, and minima of a label
#: The recall that a document's prefixes reach for pairs at the threshold, and that of the shortest in all trees.
RECALL, SURE = 0.9995, 0.9999
_MIX = np.uint64(0x9E3779B97F4A7C15)


def matched_depth(similarity: float, trees: int = TREES, depth: int = LONGEST, recall: float = RECALL) -> int:
    """The longest prefix that, if it is the same in all trees, lets pairs of that similarity meet with that probability."""
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


class _WordHashes(dict):
    """64-bit hashes of words; bounded, for it is emptied when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, words: dict[bytes, int] | None = None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles. Fewer words than width make one shingle; none, none."""
    split = (text or "").encode("utf-8", "surrogatepass").split()
    if not split:
        return np.empty(0, np.uint64)
    words = _WordHashes() if words is None else words
    w = np.fromiter(map(words.__getitem__, split), np.uint64, len(split))
    n = max(1, len(w) - width + 1)
    h = np.full(n, len(w) if len(w) < width else width, np.uint64)
    for i in range(min(width, len(w))):
        h = h * _MIX + w[i : i + n]
    return np.unique(_mixed(h))


def labels(h: np.ndarray, factors: np.ndarray) -> bytes:
    """The labels of all trees one after the other: minima of 16 bits, big-endian, so that byte order is trie order."""
    short = (h >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(factors), np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(short), 1024):
        part = short[None, i : i + 1024] * factors[:, None]
        part ^= part >> np.uint32(15)
        np.minimum(low, (part * np.uint32(0x2C1B3C6D)).min(axis=1), out=low)
    return (low & np.uint32(0xFFFF)).astype(">u2").tobytes()


def _factors(trees: int, longest: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 31, trees * longest, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def signatures(docs: DataFrame, id_col: str, text_col: str, trees: int = TREES, longest: int = LONGEST) -> DataFrame:
    """id, key (digest of the shingle set), labels; key and labels are null without words or id."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, factors = _WordHashes(), _factors(trees, longest)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                sets = [shingles(x, words) if known else () for x, known in zip(part["text"], part["id"].notna())]
                yield pd.DataFrame({
                    "id": part["id"],
                    "key": [xxhash.xxh128_digest(h.tobytes()) if len(h) else None for h in sets],
                    "labels": [labels(h, factors) if len(h) else None for h in sets],
                })

    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInPandas(sign, f"id {kind}, key binary, labels binary")


def _node(table: Column, depth: int, longest: int) -> Column:
    """The trie node of a tree's label at some depth."""
    return F.xxhash64(table, F.lit(depth), F.substring("labels", table * (2 * longest) + 1, F.lit(2 * depth)))


def _need(missed: float) -> float:
    return -math.log(missed)


def chosen_depths(sizes: dict[int, list[int]], shortest: int, longest: int, similarity: float, recall: float) -> dict[int, int]:
    """The prefix length in each tree with company, given the sizes of its nodes from the shortest prefix to the longest.

    The other trees add nothing: whoever is no company there at the shortest prefix has to be met in these. Prefixes shorten, that of the smallest next node first (sizes compare by
    powers of two, so that a mate or two don't decide), until a pair of that similarity meets with the target recall.
    """
    gain = {d: _need(1 - similarity**d) for d in range(shortest, longest + 1)}
    depth = dict.fromkeys(sorted(sizes), longest)
    have = len(sizes) * gain[longest]
    while have < _need(1 - recall):
        open_ = [t for t in depth if depth[t] > shortest]
        if not open_:
            break
        t = min(open_, key=lambda t: (sizes[t][depth[t] - 1 - shortest].bit_length(), t))
        have += gain[depth[t] - 1] - gain[depth[t]]
        depth[t] -= 1
    return depth


def forest_nodes(classes: DataFrame, trees: int, longest: int, similarity: float, recall: float) -> DataFrame:
    """no, table, node: of each class the tree nodes below which it is to be compared, alone or with others."""
    shortest = matched_depth(similarity, trees, longest, SURE)
    every = classes.select("no", F.explode(F.array(*[F.struct(F.lit(t).alias("table"), _node(F.lit(t), shortest, longest).alias("node")) for t in range(trees)])).alias("x")).select("no", "x.*")
    full = every.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = written(every.join(full.repartition("node", "n"), "node"), "met")  # see links.components()
    depths = F.array(*[F.struct(F.lit(d).alias("depth"), _node(F.col("table"), d, longest).alias("node")) for d in range(shortest, longest + 1)])
    prefixes = met.select("no", "table").join(classes.select("no", "labels"), "no").select("no", "table", F.explode(depths).alias("x"))
    prefixes = written(prefixes.select("no", "table", "x.*"), "prefixes")
    sizes = prefixes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).repartition("node", "n")
    mine = prefixes.join(sizes, "node").groupBy("no").agg(F.sort_array(F.collect_list(F.struct("table", "depth", "n", "node"))).alias("x"))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes: set[int] = set()
            for rows in batch["x"]:
                levels: dict[int, list] = {}
                for x in rows:  # by tree, then by depth
                    levels.setdefault(x["table"], []).append(x)
                depth = chosen_depths({t: [int(x["n"]) for x in xs] for t, xs in levels.items()}, shortest, longest, similarity, recall)
                nodes.update(xs[depth[t] - shortest]["node"] for t, xs in levels.items())
            yield pd.DataFrame({"node": list(nodes)}, dtype="int64")

    picked = mine.mapInPandas(choose, "node long").distinct().withColumn("is", F.lit(True))
    # a node that one document chose is that of all below it; of nested ones the outer counts
    return prefixes.join(picked.repartition("node", "is"), "node").groupBy("no", "table").agg(F.min_by("node", "depth").alias("node"))


def linked(sets: list[np.ndarray], blocks: np.ndarray, crossed: bool, threshold: tuple[int, int] = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (a < b) with Jaccard similarity of at least the threshold; across blocks only, if crossed."""
    up, down = threshold
    sizes = np.array([len(s) for s in sets])
    n = len(sets)
    if n <= 4:
        shared = np.zeros((n, n), np.int64)
        for i in range(n):
            for j in range(i + 1, n):
                if down * min(sizes[i], sizes[j]) >= up * max(sizes[i], sizes[j]):
                    shared[i, j] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        values, rows = np.concatenate(sets), np.repeat(np.arange(n), sizes)
        order = np.argsort(values, kind="stable")
        values, rows = values[order], rows[order]
        column = np.concatenate([[0], np.cumsum(values[1:] != values[:-1])])
        often = np.bincount(column)[column] > 1  # the rest is in one set only
        rows, column = rows[often], column[often]
        column = np.concatenate([[0], np.cumsum(column[1:] != column[:-1])]) if len(column) else column
        total = np.zeros((n, n), np.float32)
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            lo, hi = np.searchsorted(column, [first, first + 4096])
            part = np.zeros((n, 4096), np.float32)
            part[rows[lo:hi], column[lo:hi] - first] = 1
            total += part @ part.T
        shared = np.rint(total).astype(np.int64)
    close = (up + down) * shared >= up * (sizes[:, None] + sizes[None, :])
    if crossed:
        close &= blocks[:, None] != blocks[None, :]
    a, b = np.nonzero(np.triu(close, 1))
    return a, b


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words = _WordHashes()

    def read(row) -> tuple | None:  # noqa: ANN001
        """The row's class with its shingles; nothing for another text of the representative's id."""
        h = shingles(row.text, words)
        return (row.no, row.own, row.copies, row.leader, row.marks, h) if xxhash.xxh128_digest(h.tobytes()) == row.key else None

    for (_, table, i, j), classes in links.units(batches, BY, "no", read):
        classes.sort(key=lambda c: c[0])  # then the smallest index is the smallest number
        numbers, blocks, copies, leaders, marks, sets = zip(*classes)
        a, b = linked(list(sets), np.array(blocks), i != j)
        first = links.met_first(np.array(leaders), np.stack(marks), table, a, b)
        if first.any():
            yield links.unit_report(np.array(numbers), np.array(copies), a[first], b[first])


BY = ["node", "table", "unit_i", "unit_j"]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: int = TREES, longest: int = LONGEST, recall: float = RECALL) -> DataFrame:
    """One row per row of docs: id, component_id, copies, n_links, kept.

    n_links counts the other documents of Jaccard similarity >= 0.8 over five-word shingles (words as they are, split
    at ASCII white space; texts of one to four words are one shingle). component_id is the smallest id reachable by
    links; the row whose id that is is kept. Rows without words (null, empty) or without an id link with nothing, are
    their own component and kept. Rows that share an id and a text are copies that stay or go together. An empty table
    gives an empty table; other columns, whatever their names, are ignored.
    """
    signed = written(signatures(docs, id_col, text_col, trees, longest), "signatures")
    classes = links.numbered(signed.filter("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("labels").alias("labels")))
    members = written(forest_nodes(classes, trees, longest, THRESHOLD[0] / THRESHOLD[1], recall), "members")
    met, led = links.meetings(members)
    nodes = members.groupBy("no").agg(F.map_from_entries(F.collect_list(F.struct("table", "node"))).alias("m")).join(led, "no")
    marks = nodes.select("no", "leader", F.array(*[F.coalesce(F.try_element_at("m", F.lit(t)), F.col("no")) for t in range(trees)]).alias("marks"))
    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text"))
    known = classes.select("no", "key", "rep", "copies").join(marks, "no").join(texts, "rep").drop("rep")  # each text once
    placed = links.in_blocks(met, F.col("n"), F.col("no")).select(*BY, "own", "no")
    ready = placed.join(known, "no").repartition(*BY).sortWithinPartitions(*BY)
    found = written(ready.mapInPandas(_compare, links.REPORT), "links")
    return links.resolve(signed.withColumnRenamed("id", id_col), classes.select("no", "key", "rep", "copies"), found, id_col)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component: of the smallest id, then the smallest digest of the text. An id that holds
    several texts is told apart by their digests, and rows repeated with equal id and text are one. Rows that link with
    nothing (without an id or words) stay, repeated ones too.
    """
    text = F.col(text_col)
    mark = F.struct(F.col(id_col).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("text"))
    marked = docs.withColumn("__mark", F.when(F.col(id_col).isNotNull() & text.rlike(WORD), mark))
    gone = near_duplicates(marked.select("__mark", text_col), "__mark", text_col).filter("NOT kept").select(F.col("__mark").alias("__gone")).distinct()
    order = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    one = first_by(marked.filter("__mark IS NOT NULL"), ["__mark"], [order])
    return one.join(gone, F.col("__mark") == F.col("__gone"), "left_anti").unionByName(marked.filter("__mark IS NULL")).drop("__mark")
