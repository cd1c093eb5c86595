"""Near-duplicate embeddings by Euclidean p-stable hashing.

A normalised vector is projected on Gaussian directions, shifted and cut into steps; the steps of one table's
projections are its bucket there. Vectors of cosine c are sqrt(2 - 2c) apart, which fixes the chance to share a
bucket. Vectors that share one are compared by their exact cosine in double precision.

The number of projections follows the number of vectors, so that few unrelated ones share a bucket however many there
are, and the number of tables follows the target recall: both grow with the logarithm and a small power of the rows.
A pair that shares buckets of several tables counts in the first of these only, which both bucket lists tell without
a list of pairs. Equal vectors are one class throughout; large buckets are compared in blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from siltmill.llm import links
from siltmill.llm.tables import written

THRESHOLD = 0.95
STEP = 2.0
#: Unrelated vectors that a vector may share a table's bucket with, on average.
STRANGERS = 0.1
RECALL = 0.998


def meeting_chance(cosine: float, projections: int, tables: int, step: float = STEP) -> float:
    """The probability that vectors of that cosine share a bucket of some table."""
    far = math.sqrt(2 - 2 * cosine)
    if far == 0:
        return 1.0
    t = step / far
    one = math.erf(t / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))
    return 1 - (1 - one**projections) ** tables


def plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL, strangers: float = STRANGERS, step: float = STEP) -> tuple[int, int]:
    """Projections of a table and tables, for n vectors: at right angles, all but `strangers` of them differ in a
    table's bucket; at the threshold, two share one of some table with the target recall."""
    apart = meeting_chance(0.0, 1, 1, step)
    projections = max(4, math.ceil(math.log(max(n, 2) / strangers) / -math.log(apart)))
    near = meeting_chance(threshold, projections, 1, step)
    return projections, 1 if near >= recall else math.ceil(math.log(1 - recall) / math.log1p(-near))


def _usable(v: object) -> np.ndarray | None:
    """The vector in double precision with -0 as 0; None if it is null, empty, zero or not finite throughout."""
    if v is None:
        return None
    x = np.asarray(v)
    if x.dtype == object:
        x = np.array([np.nan if c is None else c for c in x], dtype=np.float64)
    x = x.astype(np.float64) + 0.0
    return x if len(x) and np.isfinite(x).all() and x.any() else None


def unit_vectors(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # the squares of very small or large components stay in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def buckets(x: np.ndarray, tables: int, projections: int, step: float) -> np.ndarray:
    """Rows by tables, 32 bits each; vectors of other lengths have other directions."""
    rng = np.random.default_rng([x.shape[1], tables, projections])
    directions = rng.standard_normal((x.shape[1], tables * projections))
    shifts = rng.uniform(0, step, tables * projections)
    factors = rng.integers(1, 1 << 63, projections, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    steps = np.floor((unit_vectors(x) @ directions + shifts) / step).astype(np.int64).view(np.uint64)
    mixed = (steps.reshape(len(x), tables, projections) * factors).sum(axis=2, dtype=np.uint64)
    return (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for whole in batches:
        for at in range(0, len(whole), 1000):
            batch = whole.iloc[at : at + 1000]
            vectors = [None if missing else _usable(v) for v, missing in zip(batch["embedding"], batch["id"].isna())]
            yield pd.DataFrame({"id": batch["id"], "key": [None if v is None else hashlib.md5(v.tobytes()).digest() for v in vectors], "vector": vectors})


def linked(x: np.ndarray, leaders: np.ndarray, marks: np.ndarray, table: int, blocks: np.ndarray, crossed: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (a < b) of at least that cosine that meet in this table for the first time."""
    close = x @ x.T >= threshold
    if crossed:
        close &= blocks[:, None] != blocks[None, :]
    a, b = np.nonzero(np.triu(close, 1))
    first = links.met_first(leaders, marks, table, a, b)
    return a[first], b[first]


BY = ["node", "table", "unit_i", "unit_j", "size"]


def _lists(column: pa.ListArray, lo: int, hi: int) -> np.ndarray:
    """Rows lo to hi of a column of lists of equal length as a matrix."""
    ends = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[ends[lo] : ends[hi]].reshape(hi - lo, -1)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Runs of rows with equal BY in sorted batches, which may span batches, as arrays by column."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        flat = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*BY, "own", "no", "copies", "leader")}
        ends = np.flatnonzero(np.any([flat[c][1:] != flat[c][:-1] for c in BY], axis=0)) + 1
        for lo, hi in zip([0, *ends.tolist()], [*ends.tolist(), batch.num_rows]):
            run = {c: x[lo:hi] for c, x in flat.items()} | {c: _lists(batch.column(c), lo, hi) for c in ("vector", "buckets")}
            if held and any(held[0][c][0] != run[c][0] for c in BY):
                yield {c: np.concatenate([h[c] for h in held]) for c in held[0]}
                held = []
            held.append(run)
    if held:
        yield {c: np.concatenate([h[c] for h in held]) for c in held[0]}


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL, strangers: float = STRANGERS, step: float = STEP) -> DataFrame:
    """One row per row of vectors: id, component_id, copies, n_links, kept.

    Vectors that are null, empty or zero, or hold nulls or non-finite components, link with nothing, like rows without
    an id; vectors of different lengths never link. Repeated rows are copies and link with each other. An empty table
    gives an empty table; other columns, whatever their names, are ignored.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    vector = "array<float>" if vectors.schema[vector_col].dataType.elementType == FloatType() else "array<double>"  # no wider than it came
    slim = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"))
    keyed = written(slim.mapInPandas(_keyed, f"id {kind}, key binary, vector {vector}"), "vectors")
    classes = links.numbered(keyed.filter("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")))
    projections, tables = plan(classes.count(), threshold, recall, strangers, step)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.iloc[at : at + 1000]
                sizes = batch["vector"].map(len)
                for size in sizes.unique():
                    mine = batch[sizes == size]
                    yield pd.DataFrame({"no": mine["no"], "buckets": list(buckets(np.stack(mine["vector"]).astype(np.float64), tables, projections, step))})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _units(batches):
            order = np.argsort(unit["no"])  # then the smallest index is the smallest number
            u = {c: x[order] for c, x in unit.items()}
            a, b = linked(unit_vectors(u["vector"].astype(np.float64)), u["leader"], u["buckets"], int(u["table"][0]), u["own"], bool(u["unit_i"][0] != u["unit_j"][0]), threshold)
            if len(a):
                yield pa.RecordBatch.from_pandas(links.unit_report(u["no"], u["copies"], a, b), preserve_index=False)

    signed = written(classes.select("no", "vector").mapInPandas(sign, "no long, buckets array<int>"), "buckets")
    spread = signed.select("no", F.posexplode("buckets").alias("table", "bucket"))
    bucket = F.shiftleft(F.col("table").cast("long"), 32).bitwiseOR(F.col("bucket").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    every = spread.select("no", "table", bucket.alias("node"))
    shared = every.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(every.join(shared.repartition("node", "n"), "node").select("no", "table", "node"), "members")  # see links.components()
    met, led = links.meetings(members)
    known = classes.select("no", "copies", "vector", F.size("vector").alias("size")).join(signed, "no").join(led, "no")
    placed = links.in_blocks(met, F.col("n"), F.col("no")).select(*BY[:-1], "own", "no")
    ready = placed.join(known, "no").repartition(*BY).sortWithinPartitions(*BY)
    found = written(ready.mapInArrow(compare, links.REPORT), "links")
    return links.resolve(keyed.select(F.col("id").alias(id_col), "key"), classes.select("no", "key", "rep", "copies"), found, id_col)
