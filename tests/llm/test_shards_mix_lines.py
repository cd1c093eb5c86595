from collections import Counter

from pyspark.sql import functions as F

from siltmill.llm import line_ratio as l
from siltmill.llm import shard_table as s
from siltmill.llm import source_mix as m


def test_table_is_even_and_moves_little():
    names = [f"n{i}" for i in range(8)]
    full, less = s.fill(names, 809), s.fill(names[:-1], 809)
    counts = Counter(full)
    assert set(counts) == set(names) and max(counts.values()) - min(counts.values()) <= 1
    assert s.fill(names[::-1] + names, 809) == full
    moved = sum(a != b for a, b in zip(full, less) if a != names[-1])
    assert moved < 0.25 * 809
    assert s.fill(["only"], 2) == ["only", "only"]


def test_fill_refuses_nonsense():
    for bad in (([], 7), (["a"], 8), (["a"], 1)):
        try:
            s.fill(*bad)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_place_is_native_and_total(spark):
    rows = [(1, "x", "y"), (1, "z", "y"), (None, "x", "y"), (7, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, shard string, slot string")
    got = s.place(df, "doc_id").collect()
    owner = s.fill(s.SHARDS)
    assert len(got) == 4 and all(r["shard"] == owner[r["slot"]] for r in got)
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == 1
    assert s.place(spark.createDataFrame([], "doc_id long"), "doc_id").count() == 0
    plan = s.place(df, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan


def test_written_shards_hold_all_rows(spark, tmp_path):
    df = spark.range(500).select(F.when(F.col("id") < 200, 1).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    s.write_shards(df, str(tmp_path / "out"), "doc_id", ["a", "b", "c"], 211, files=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500 and back.filter("doc_id = 1").select("shard").distinct().count() == 1


def docs_of(spark, sizes):
    rows = [(i, "w " * n, src) for i, (src, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def water_fill(sizes):
    names = sorted((x for x in sizes if x is not None), key=lambda x: x.encode()) + [None] * (None in sizes)
    weight = {x: i % 3 + 1 for i, x in enumerate(names)}
    target, total = {}, sum(sizes.values())
    while True:
        left = total - sum(target.values())
        rest = [x for x in names if x not in target]
        over = [x for x in rest if left * weight[x] / sum(weight[y] for y in rest) >= 3 * sizes[x]]
        if not over:
            return target | {x: left * weight[x] / sum(weight[y] for y in rest) for x in rest}
        target |= {x: 3 * sizes[x] for x in over}


def test_targets_and_copies(spark):
    sizes = [("b", 5 + i % 40) for i in range(300)] + [("a", 10)] * 7 + [("Z", 1 + i) for i in range(60)] + [(None, 8)] * 50 + [("é", 3)] * 90 + [("zero", 0)] * 4
    got = m.mix(docs_of(spark, sizes)).collect()
    by = Counter()
    for src, n in sizes:
        by[src] += n
    want = water_fill(by)
    taken = Counter()
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["source_size"] == by[r["source"]]
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for src, t in want.items():
        assert abs(taken[src] - t) <= max(3 * 45, 0.05 * t), (src, taken[src], t)
    again = m.mix(docs_of(spark, sizes).repartition(7)).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in got) == sorted((r["doc_id"], r["copies"]) for r in again)


def test_mix_edges(spark):
    rows = [(1, None, None, 1), (1, None, None, 1), (None, "a b", "s", 1), (None, "a b", "s", 1), (2, "", "s", 1), (3, "x " * 50_000, "t", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    assert m.mix(df).count() == 6
    out = m.emit(df)
    assert out.columns == df.columns and out.filter("size <> 1").count() == 0
    assert out.count() == m.mix(df).agg(F.sum("copies")).first()[0]
    empty = spark.createDataFrame([], df.schema)
    assert m.mix(empty).count() == m.emit(empty).count() == 0


SPACE = " \t\n\x0b\x0c\r"


def brute_lines(rows, ratio, least):
    pages, on = Counter(), Counter()
    for _, host, text in rows:
        if host is not None:
            pages[host] += 1
            on.update({(host, x.strip(SPACE)) for x in (text or "").split("\n") if x.strip(SPACE)} if text is not None else ())
    return [None if t is None else "\n".join(x for x in t.split("\n") if not x.strip(SPACE) or not (on[h, x.strip(SPACE)] >= least and on[h, x.strip(SPACE)] > ratio * pages[h])) for _, h, t in rows]


def test_boilerplate_goes_by_host(spark, monkeypatch):
    rows = [(i, "h", f"menu \nown {i}\n\nfoot" if i % 3 else f"own {i}\nrare") for i in range(20)] + [(30 + i, "g", "menu\nmenu\nx") for i in range(2)]
    rows += [(50, None, "menu"), (51, "h", None), (52, "h", ""), (53, None, None), (20, "h", "menu\nrare"), (20, "h", "menu\nrare")]
    # a host of other line ends: its blank lines stay, its menu goes in either form
    rows += [(60 + i, "crlf", f"menu\r\n\r\n\t\r\nown {i}\r\n\x0bfoot\t\r\n\x0cmenu\xa0\r") for i in range(9)] + [(70 + i, "crlf", f"menu\n\nown {i}\nfoot") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    want = sorted(map(repr, zip([r[0] for r in rows], brute_lines(rows, 0.3, 3))))
    for most in (l.MOST_BROADCAST, -1):  # both joins
        monkeypatch.setattr(l, "MOST_BROADCAST", most)
        got = l.drop_boilerplate(df, ratio=0.3).collect()
        assert sorted(repr((r["doc_id"], r["text"])) for r in got) == want
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[60]["text"] == "\r\n\t\r\nown 0\r" and by_id[70]["text"] == "\nown 0"
    assert (by_id[1]["n_lines"], by_id[1]["n_dropped"], by_id[51]["n_lines"], by_id[52]["n_lines"]) == (4, 2, 0, 1)
    assert l.drop_boilerplate(spark.createDataFrame([], "doc_id long, source string, text string, n_lines int")).count() == 0
