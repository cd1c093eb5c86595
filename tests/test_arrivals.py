import gzip
import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from siltmill.operators import histories, joins
from siltmill.plans import commit_pairs
from siltmill.sources import json_lines, resumed
from siltmill.storage import new_path
from siltmill.streaming import growing


def test_damaged_files_give_their_good_rows_and_a_count_of_the_rest(spark, tmp_path):
    good = [json.dumps({"a": i, "b": {"c": "é" * i}}) for i in range(5)]
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "whole file%20.json").write_text("\n".join(good[:2] + ["", "  ", '{"a": 3, "b"', "[1, 2]", "7", "null", '{"a": "no number"}', '{"z": 1}', good[2]]))
    (tmp_path / "cut.json.gz").write_bytes(gzip.compress(("\n".join(good * 2000) + "\n").encode())[:-20])
    (tmp_path / "none.json.gz").write_bytes(b"these bytes are not compressed\n")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "two.json.gz").write_bytes(gzip.compress((good[0] + "\n").encode()) + gzip.compress(good[1].encode()))
    (tmp_path / "other.txt").write_text(good[0])
    rows = json_lines.checked_records(spark, str(tmp_path), "a long, b struct<c: string>").cache()
    name = lambda r: r.file.rsplit("/", 1)[-1]
    found = {name(r): (r.n_records, r.n_rejected, r.is_cut) for r in json_lines.problems(rows).collect()}
    cut = found.pop("cut.json.gz")
    assert found == {"whole file%20.json": (4, 5, False), "none.json.gz": (0, 0, True), "two.json.gz": (2, 0, False)}
    assert cut[2] and 0 < cut[0] < 10_000 and cut[1] <= 1
    told = sorted((r.line, r.problem, r.text, r.a, r.b and r.b.c) for r in rows.collect() if name(r).startswith("whole"))
    assert [t[0] for t in told] == [0, 1, 4, 5, 6, 7, 8, 9, 10]
    assert told[1] == (1, None, None, 1, "é") and told[2] == (4, "line", '{"a": 3, "b"', None, None) and told[7] == (9, None, None, None, None)
    last = [r for r in rows.collect() if r.problem == "end"]
    assert all((r.line, r.text, r.a, r.b) == (None,) * 4 for r in last) and len(last) == 2


def test_lines_longer_than_a_chunk(spark, tmp_path):
    (tmp_path / "long.json.gz").write_bytes(gzip.compress(b'{"a": 1, "t": "' + b"y" * (3 << 20) + b'"}\n{"a": 2}\n'))
    got = {r.a: r.n for r in json_lines.checked_records(spark, str(tmp_path), "a long, t string").select("a", F.length("t").alias("n")).collect()}
    assert got == {1: 3 << 20, 2: None}


def test_a_stopped_job_goes_on_and_rewrites_nothing(spark, tmp_path):
    df = spark.range(300).selectExpr("id", "CASE WHEN id % 7 < 6 THEN concat('k', id % 7) END AS k", "id % 2 AS v")
    path = str(tmp_path / "t")
    files = lambda: {p.relative_to(path): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part-*.parquet") if "_finished" not in str(p)}
    assert resumed.write_partitions(df, path, "k", at_once=2, most=3) == 3
    first = files()
    # what a run leaves that stops before it names its group: half of a partition
    df.filter("k = 'k4' AND id < 100").write.mode("append").partitionBy("k").parquet(path)
    assert resumed.write_partitions(df, path, "k", at_once=2) == 4
    assert {f: t for f, t in files().items() if f in first} == first
    back = lambda: sorted(map(tuple, spark.read.schema(df.schema).parquet(path).select("id", "k", "v").collect()), key=str)
    assert back() == sorted(map(tuple, df.collect()), key=str)
    whole = files()
    assert resumed.write_partitions(df, path, "k") == 0 and files() == whole
    counts = {r.k: r.n_rows for r in resumed.finished(spark, path, df.schema["k"]).collect()}
    assert counts == {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    assert resumed.write_partitions(df.limit(0), str(tmp_path / "none"), "k") == 0


def test_variant_events_keep_unknown_shapes(spark):
    lines = [
        '{"type": "PullRequestEvent", "payload": {"action": "opened", "pull_request": {"url": "https://api.host/repos/a/b/pulls/1", "merged": "odd", "novel": [1, {"x": 2}]}}}',
        '{"type": "PullRequestEvent", "payload": {"pull_request": {"url": "https://api.host/repos/a/b/pulls/2", "merged": true, "head": 5}}, "actor": null}',
        '{"type": 3}', '{"type": ', None, "[]",
    ]
    df = histories.variant_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    kept = df.select("value", F.try_variant_get("event", "$.payload.pull_request.novel[1].x", "int").alias("x"), "payload.action", F.col("payload.pull_request.merged").alias("merged"), F.col("event").isNull().alias("bad")).collect()
    assert [(r.x, r.action, r.merged, r.bad) for r in kept] == [(2, "opened", None, False), (None, None, True, False), (None,) * 3 + (False,), (None,) * 3 + (True,), (None,) * 3 + (True,), (None,) * 3 + (False,)]
    assert sorted(r.group_id for r in histories.flat_events(df).collect()) == ["a/b/pull/1", "a/b/pull/2"]
    lists = spark.createDataFrame([("[1, {}]",), (None,), ("null",), ("{}",), ("[",), ("[]",)], "e string")
    assert [r.n for r in lists.select(F.size(histories.listed_events(F.col("e"))).alias("n")).collect()] == [2, 0, 0, 0, 0, 0]


@pytest.mark.parametrize("idle", [0, growing.IDLE])
def test_a_stream_ends_with_the_histories_of_the_table(spark, idle):
    """Over several batches and two runs; with no idleness allowed, parts end and later events begin others."""
    raw = spark.range(60).selectExpr(
        "CASE id % 3 WHEN 0 THEN 'PullRequestEvent' WHEN 1 THEN 'IssueCommentEvent' ELSE 'PullRequestReviewEvent' END AS type",
        "concat('2020-01-01T00:00:', lpad(60 - id, 2, '0'), 'Z') AS created_at",
        "CASE WHEN id % 3 = 1 THEN named_struct('id', id % 4, 'pull_request', named_struct('url', concat('https://api.host/repos/a/b/pulls/', id % 4))) END AS issue",
        "CASE WHEN id % 3 <> 1 THEN named_struct('url', concat('https://api.host/repos/a/b/pulls/', id % 4), 'merged', id % 9 = 0) END AS pull_request",
        "IF(id % 5 = 0, 'closed', 'edited') AS action",
    )
    raw = raw.select("type", "created_at", F.struct("action", "issue", "pull_request").alias("payload")).select(F.to_json(F.struct("*")).alias("j")).select(F.from_json("j", histories.RAW).alias("e")).select("e.*")
    flat = histories.flat_events(raw)
    source, out, state = (new_path(spark, n) for n in ("flat", "out", "state"))
    for part in ("created_at < '2020-01-01T00:00:30Z'", "created_at >= '2020-01-01T00:00:30Z'"):
        flat.filter(part).coalesce(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(flat.schema).option("maxFilesPerTrigger", 1).parquet(source)
        growing.followed(stream, out, state, idle)
    parts = spark.read.parquet(out)
    assert (parts.agg(F.max("part")).first()[0] > 0) == (idle == 0)
    key = lambda df: sorted((r.pull_guid, str(r.events)) for r in df.collect())
    assert key(growing.pull_histories(parts, flat)) == key(histories.pull_histories(flat))


def test_files_side_by_side_within_a_row(spark):
    f = "array<struct<path:string,content:string>>"
    rows = [
        (1, [("b", "1"), ("a", "2"), ("a", "3")], [("a", "4"), ("c", "5"), ("b", "6"), ("a", "7")]),
        (2, [("x", "1")], [("y", "2")]), (3, [], []), (4, None, [("a", "1")]), (5, [(None, "1")], [(None, "2")]), (6, [("a", None)], [("a", None)]),
    ]
    df = spark.createDataFrame(rows, f"k int, base_files {f}, head_files {f}")
    got = {r.k: r.p and [(p.base.path, p.base.content, p.head.content) for p in r.p] for r in df.select("k", joins.paired(F.col("base_files"), F.col("head_files")).alias("p")).collect()}
    assert got == {1: [("a", "3", "7"), ("b", "1", "6")], 2: [], 3: [], 4: None, 5: [(None, "1", "2")], 6: [("a", None, None)]}


def test_all_steps_are_counted_by_one_pass(spark):
    f = "array<struct<path:string,content:string,language:string>>"
    rows = [("g", "h", None, [("p", "x", "C")], [("p", "y", "C")]), ("g", "h", "a/b", None, [("p", "y", "C")]), (None, None, "a/b", [("p", None, "C")], [("p", "y", None)]), ("g", "h", "a/b", [("p", "x", "C")], [("p", "x", "C")])]
    pairs = spark.createDataFrame(rows, f"pull_guid string, head_commit_id string, repo_name string, base_files {f}, head_files {f}")
    path = new_path(spark, "pairs")
    pairs.write.parquet(path)
    pairs = spark.read.parquet(path)
    licenses = spark.createDataFrame([("a/b", "no_license"), ("a/b", "no_license")], "repo_name string, license_type string")
    none = spark.createDataFrame([], "repo_name string"), spark.createDataFrame([], "user string")
    steps = commit_pairs.prepared(pairs, licenses, *none)
    counts = commit_pairs.funnel(steps)
    assert {r.step: r.n_rows for r in counts.collect()} == {"original": 4, "licensed": 3, "not_opted_out": 3, "with_diffs": 2, "not_too_big": 2, "valid": 1}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and plan.count("ranges(") == 1
    assert {r.n_rows for r in commit_pairs.funnel(commit_pairs.prepared(pairs.limit(0), licenses, *none)).collect()} == {0}


def test_a_key_sets_its_timer_once_a_part():
    """Each timer is a message to the JVM; one that fires while events still come is set anew, else the part ends."""
    calls, kept, listed, now = [], {"part": None}, [], [1000]
    value = SimpleNamespace(get=lambda: kept["part"], update=lambda x: kept.update(part=x))
    events = SimpleNamespace(get=lambda: list(listed), appendList=listed.extend, clear=listed.clear)
    clock = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now[0])
    grows = growing._Growing(5)
    grows.init(SimpleNamespace(getListState=lambda *_: events, getValueState=lambda *_: value, registerTimer=calls.append))
    for now[0], e in ((1000, "a"), (3000, "b"), (5000, "c")):
        got = list(grows.handleInputRows(("g",), iter([{"event": e}]), clock))
    assert [tuple(r) for r in got] == [("g", 0, ["a", "b", "c"])] and calls == [6000]
    now[0] = 7000
    assert list(grows.handleExpiredTimer(("g",), clock, None)) == [] and calls == [6000, 10000] and len(listed) == 3
    now[0] = 10001
    assert list(grows.handleExpiredTimer(("g",), clock, None)) == [] and listed == []
    assert [tuple(r) for r in grows.handleInputRows(("g",), iter([{"event": "d"}]), clock)] == [("g", 1, ["d"])]
