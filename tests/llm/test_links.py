import random

import numpy as np
import pytest

from siltmill.llm import jaccard_forest as j
from siltmill.llm import links, queries
from siltmill.llm import vector_hash as v


def brute(items, copies, alike):
    """Per item: links weighted by copies, and component's smallest index."""
    n = len(items)
    root, deg = list(range(n)), [c - 1 for c in copies]
    for a in range(n):
        for b in range(a + 1, n):
            if alike(items[a], items[b]):
                deg[a] += copies[b]
                deg[b] += copies[a]
                ra, rb = root[a], root[b]
                root = [min(ra, rb) if x in (ra, rb) else x for x in root]
    return deg, root


def test_components_of_chains_stars_and_repeats(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(500, 500)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] * 2
    got = {r["id"]: r["root"] for r in links.components(spark.createDataFrame(edges, "id long, root long")).collect()}
    ids = sorted({x for e in edges for x in e})
    want = {i: i for i in ids}
    for _ in ids:
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert got == {i: r for i, r in want.items() if i != r}
    assert links.components(spark.createDataFrame([], "id long, root long")).count() == 0


def words(rng, n):
    return [f"w{rng.randrange(400)}" for _ in range(n)]


def near_texts(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(25):
        base = words(rng, rng.randrange(30, 120))
        for _ in range(rng.randrange(1, 5)):
            other = list(base)
            for _ in range(rng.randrange(0, 4)):
                other[rng.randrange(len(other))] = "changed"
            texts.append(" ".join(other))
    return texts


def check_jaccard(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, copies string, kept string")
    got = {r["doc_id"]: r for r in j.near_duplicates(df).collect()}
    sets = [j.shingles(t) for _, t, *_ in rows]

    def alike(a, b):
        a, b = set(sets[a].tolist()), set(sets[b].tolist())
        return bool(a) and bool(b) and 5 * len(a & b) >= 4 * len(a | b)

    deg, root = brute(list(range(len(rows))), [1] * len(rows), alike)
    for k, row in enumerate(rows):
        assert (got[row[0]]["n_links"], got[row[0]]["component_id"]) == (deg[k], rows[root[k]][0]), row


def test_jaccard_join_matches_brute_force(spark):
    texts = near_texts(1) + ["", None, "one", "one", "two words", "a b c d", "a b c d e", "a b c d e"]
    check_jaccard(spark, [(i, t, "k", "c", "x") for i, t in enumerate(texts)])


def test_large_group_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(links, "BLOCK", 7)
    monkeypatch.setitem(links.in_blocks.__globals__, "BLOCK", 7)
    monkeypatch.setattr(links.in_blocks, "__defaults__", (7,))
    rng = random.Random(5)
    base = words(rng, 200)
    texts = []
    for i in range(40):
        t = list(base)
        t[i * 4] = f"own{i}"
        texts.append(" ".join(t))
    check_jaccard(spark, [(i, t, None, None, None) for i, t in enumerate(texts + texts[:9])])


def test_jaccard_edges(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (5, "x " * 30_000)]
    got = j.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["n_links"], r["kept"]) for r in got) == [(0, 0, 0, True), (1, 1, 2, True), (2, 1, 2, False), (2, 1, 2, False), (3, 3, 0, True), (4, 4, 0, True), (5, 5, 0, True)]
    left = j.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 3, 4, 5]
    assert j.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ids_shared_by_different_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail")]
    got = sorted((r["doc_id"], r["component_id"], r["n_links"]) for r in j.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_units_pass_over_repeated_rows():
    import pandas as pd

    batches = [pd.DataFrame({"g": [1, 1, 1], "key": [b"a", b"a", b"b"], "v": [0, 1, 2]}), pd.DataFrame({"g": [1, 2, 3], "key": [b"b", b"a", b"c"], "v": [3, 4, 0]})]
    got = list(links.units(iter(batches), ["g"], "key", lambda row: row.v or None))
    assert got == [((1,), [1, 2]), ((2,), [4])]


def test_depth_follows_the_target_recall():
    assert j.matched_depth(0.8, 16, 6, 0.998) == 5
    assert j.matched_depth(0.8, 16, 6, 0.99999) < 5
    assert j.matched_depth(0.99, 16, 6, 0.9) == 6


def test_prefixes_shorten_where_it_crowds_least():
    pair = lambda depth: 1 - np.prod([1 - 0.8**d for d in depth.values()])
    crowd = {t: [4000 * (t + 1), 900 * (t + 1), 200 * (t + 1), 70] for t in range(24)}
    got = j.chosen_depths(crowd, 5, 8, 0.8, 0.998)
    assert 0.998 <= pair(got) < 0.9995 and got[0] < got[23] > 5
    few = {t: crowd[t] for t in (3, 9)}
    assert j.chosen_depths(few, 5, 8, 0.8, 0.998) == {3: 5, 9: 5}  # nobody is met in the other trees
    assert set(j.chosen_depths(crowd, 5, 8, 0.8, 1 - 1e-12).values()) == {5}  # out of reach: as short as can be


def test_crowded_nodes_lose_no_link(spark):
    """Templates that share two thirds of their shingles, with near copies among them, where any node counts as crowded."""
    rng = random.Random(11)
    frame = words(rng, 260)
    texts = []
    for i in range(40):
        own = [f"own{i}w{k}" for k in range(60)]
        texts += [" ".join(frame + own), " ".join(frame + own[:-6] + [f"tail{i}"] * 3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(j.shingles(t).tolist()) for t in texts]
    deg, root = brute(list(range(len(texts))), [1] * len(texts), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    got = {r["doc_id"]: (r["n_links"], r["component_id"]) for r in j.near_duplicates(df).collect()}
    assert got == {i: (deg[i], root[i]) for i in range(len(texts))}
    signed = j.signatures(df, "doc_id", "text").withColumnRenamed("id", "no")
    fullest = lambda recall: j.forest_nodes(signed, j.TREES, j.LONGEST, 0.8, recall).groupBy("node").count().agg({"count": "max"}).first()[0]
    assert fullest(0.998) < fullest(1 - 1e-12)


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_documents_are_met_below_prefixes_of_several_lengths(spark):
    """On a whole table, classes with company in many trees keep longer prefixes, and no link between two texts is lost."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    signed = j.signatures(docs, "doc_id", "text").filter("key IS NOT NULL").dropDuplicates(["key"]).withColumnRenamed("id", "no")
    nodes = j.forest_nodes(signed, j.TREES, j.LONGEST, 0.8, j.RECALL)
    named = signed.crossJoin(spark.range(j.TREES).selectExpr("CAST(id AS INT) AS table"))
    lengths = {d: nodes.join(named.select("no", "table", j._node(named["table"], d, j.LONGEST).alias("node")), ["no", "table", "node"]).count() for d in range(5, j.LONGEST + 1)}
    assert sum(lengths.values()) == nodes.count() and lengths[5] and sum(n > 0 for n in lengths.values()) > 1


def test_jaccard_query_against_brute_force(spark):
    """All rows of the smallest table."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    sets = []
    for r in rows:
        w = (r["text"] or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    deg, root = brute(list(range(len(rows))), [1] * len(rows), lambda a, b: bool(sets[a]) and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    ids = [r["doc_id"] for r in rows]
    least = {k: min(ids[i] for i in range(len(rows)) if root[i] == k) for k in set(root)}
    got = queries.op1_jaccard_join(spark, "/root/testdata/sf0.001").collect()
    assert {(r["doc_id"], r["n_links"], r["class_id"], r["kept"]) for r in got} == {(ids[i], deg[i], least[root[i]], ids[i] == least[root[i]]) for i in range(len(rows))}
    assert len(got) == len(rows)


@pytest.mark.parametrize("n", [2, 3, 30])
def test_exact_intersections(n):
    rng = np.random.default_rng(n)
    sets = [np.unique(rng.integers(0, 60, 50).astype(np.uint64)) for _ in range(n)]
    a, b = j.linked(sets, np.zeros(n), False, (1, 2))
    want = [(x, y) for x in range(n) for y in range(x + 1, n) if 2 * len(set(sets[x]) & set(sets[y])) >= len(set(sets[x]) | set(sets[y]))]
    assert list(zip(a.tolist(), b.tolist())) == want


def test_vector_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((30, 16))
    x = np.concatenate([c + 0.08 * rng.standard_normal((rng.integers(1, 6), 16)) for c in centres]).astype(np.float32)
    rows = [(i, [float(c) for c in r], 1) for i, r in enumerate(x)]
    rows += [(1000, rows[0][1], 1), (1001, None, 1), (1002, [0.0] * 16, 1), (1003, [float("nan")] + [1.0] * 15, 1), (1004, [None] + [1.0] * 15, 1), (1005, [], 1), (1006, rows[0][1][:8], 1), (1007, [float("inf")] * 16, 1), (1008, [c * 1e30 for c in rows[0][1]], 1)]
    got = {r["vec_id"]: r for r in v.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, copies int")).collect()}

    def alike(a, b):
        a, b = rows[a][1], rows[b][1]
        if a is None or b is None or len(a) != len(b) or not a or None in a or None in b:
            return False
        a, b = np.array(a, np.float64), np.array(b, np.float64)
        return bool(np.isfinite([a, b]).all() and a.any() and b.any()) and (a / np.linalg.norm(a)) @ (b / np.linalg.norm(b)) >= 0.95

    deg, root = brute(list(range(len(rows))), [1] * len(rows), alike)
    for k, row in enumerate(rows):
        assert (got[row[0]]["n_links"], got[row[0]]["component_id"]) == (deg[k], rows[root[k]][0]), row[0]
        assert got[row[0]]["kept"] == (rows[root[k]][0] == row[0])


def test_vector_edges_and_recall(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-0.0, 1.0]), (3, [0.0, 1.0])]
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in v.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(0, 0, 0), (1, 1, 1), (1, 1, 1), (2, 1, 2), (3, 1, 2)]
    assert v.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    projections, tables = v.plan(400)
    assert v.meeting_chance(0.95, projections, tables) > 0.99
    rng = np.random.default_rng(0)
    a = v.unit_vectors(rng.standard_normal((400, 64)))
    side = rng.standard_normal((400, 64))
    side = v.unit_vectors(side - (side * a).sum(1, keepdims=True) * a)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * side
    met = (v.buckets(a, tables, projections, v.STEP) == v.buckets(b, tables, projections, v.STEP)).any(axis=1)
    assert met.mean() > 0.97


@pytest.mark.parametrize("n", [0, 1, 500, 10**4, 10**6, 10**9])
def test_plan_keeps_recall_and_strangers_apart(n):
    projections, tables = v.plan(n)
    assert v.meeting_chance(0.95, projections, tables) >= v.RECALL
    assert n * v.meeting_chance(0.0, projections, 1) <= v.STRANGERS or projections == 4
    assert tables < 30 * max(n, 2) ** 0.15  # a small power of the rows


def test_vector_query_against_brute_force(spark):
    """All rows of the smallest table."""
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    x = np.array([r["embedding"] for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.95
    deg, root = brute(list(range(len(rows))), [1] * len(rows), lambda a, b: close[a, b])
    ids = [r["vec_id"] for r in rows]
    least = {k: min(ids[i] for i in range(len(rows)) if root[i] == k) for k in set(root)}
    want = {(ids[i], deg[i], least[root[i]], ids[i] == least[root[i]]) for i in range(len(rows))}
    got = queries.op5_vector_dedup(spark, "/root/testdata/sf0.001").collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got} == want and len(got) == len(rows)
