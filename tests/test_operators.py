import gzip
import json
import sys

import pytest
from pyspark.sql import functions as F

from siltmill.operators import compiled, dedup, histories, instruct, joins, notebooks, tree
from siltmill.plans import commit_pairs, license_typing, pull_render, repo_merge
from siltmill.sources import readers, sinks


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_tree_walk(spark):
    entries = spark.createDataFrame([("r1", "f.txt", "c1", True), ("r1", "a", "d1", False), ("d1", "g.py", "c2", True), ("d1", "loop", "r1", False)], "parent string, name string, child string, is_file boolean")
    roots = spark.createDataFrame([("r1",), ("gone",)], "node string")
    got = rows(tree.walk(roots, entries, most_levels=2), "path")
    assert got == [("r1", "/a/g.py", "c2", 1), ("r1", "/f.txt", "c1", 0)]
    content = spark.createDataFrame([("c1", "b1", 5)], "content_id string, blob_id string, length long")
    assert [r["blob_id"] for r in tree.with_content(tree.walk(roots, entries, 2), content).collect()] == ["b1"]
    shared = spark.createDataFrame([("x", "f", "c", True)], "parent string, name string, child string, is_file boolean")
    many = spark.createDataFrame([("x",)] * 5, "node string")
    assert tree.walk(many, shared, most_per_node=3).count() == 3
    assert tree.walk(many, shared).count() == 5


def test_tree_walk_has_no_bounds_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(tree, "TALL", 4)  # the question is asked early, so that the test need not be deep
    deep = [(f"d{i}", "x", f"d{i + 1}", False) for i in range(9)] + [("d9", "end.txt", "c", True)]
    schema = "parent string, name string, child string, is_file boolean"
    root = spark.createDataFrame([("d0",)], "node string")
    assert rows(tree.walk(root, spark.createDataFrame(deep, schema)), "path") == [("d0", "/x" * 9 + "/end.txt", "c", 9)]
    assert tree.walk(root, spark.createDataFrame(deep, schema), most_levels=9).count() == 0
    with pytest.raises(ValueError, match="holds itself"):
        tree.walk(root, spark.createDataFrame([*deep, ("d9", "up", "d3", False)], schema))


def test_folder_entries(spark):
    raw = spark.createDataFrame([("d", bytearray(b"f\xff"), "file", "c"), ("d", bytearray(b"s"), "dir", "e"), ("d", bytearray(b"m"), "rev", "x"), ("d", bytearray(b"n"), None, "y")], "directory_id string, name binary, type string, target string")
    assert rows(tree.folder_entries(raw), "name") == [("d", "f\ufffd", "c", True), ("d", "s", "e", False)]


def test_previous_rows(spark):
    data = [(i % 3 if i % 7 else None, i * 2) for i in range(60)]
    got = rows(dedup.with_previous(spark.createDataFrame(data, "k int, o int"), "k", "o", "before"), "o")
    want, last = [], {}
    for k, o in data:
        if k in last:
            want.append((k, o, last[k]))
        last[k] = o
    assert got == want


def test_drawn_table_rows():
    wide = "<table><tr><th>n</th></tr>" + "".join(f"<tr><td>r{i}</td></tr>" for i in range(12)) + "</table>"
    lines = notebooks.markdown_of(wide).split("\n")[2:]
    assert len(set(lines)) == 5 and notebooks.markdown_of(wide) == notebooks.markdown_of(wide)
    drawn = {tuple(notebooks.markdown_of(wide + "x" * k).split("\n")[2:]) for k in range(20)}
    assert len(drawn) > 10  # not always the same ones


def test_diff_queries_against_the_matcher(spark):
    """All pairs of neighbours in the smallest table, by the library's matcher called on whole texts."""
    from difflib import SequenceMatcher

    from siltmill.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("source", "doc_id", "text").orderBy("source", "doc_id").collect()
    ranges = {r["doc_id"]: r for r in QUERIES["line_diff_range"](spark, "/root/testdata/sf0.001").collect()}
    patches = {r["doc_id"]: r["hunks"] for r in QUERIES["diff_hunks"](spark, "/root/testdata/sf0.001").collect()}
    pairs = [(a, b) for a, b in zip(docs, docs[1:]) if a["source"] == b["source"] and a["text"] is not None]
    assert set(ranges) == set(patches) == {b["doc_id"] for _, b in pairs}
    for a, b in pairs:
        old, new = a["text"].splitlines(), b["text"].splitlines()
        ops = [x for x in SequenceMatcher(None, old, new).get_opcodes() if x[0] != "equal"]
        got = ranges[b["doc_id"]]
        assert (got["n_deletes"], got["n_inserts"]) == (sum(x[2] - x[1] for x in ops), sum(x[4] - x[3] for x in ops))
        assert (got["old_start"], got["old_end"]) == ((ops[0][1], ops[-1][2]) if ops else (sys.maxsize, 0))
        removed = [x[1:] for x in patches[b["doc_id"]].split("\n") if x.startswith("-")]
        added = [x[1:] for x in patches[b["doc_id"]].split("\n") if x.startswith("+")]
        assert removed == [x for op in ops for x in old[op[1] : op[2]]] and added == [x for op in ops for x in new[op[3] : op[4]]]


def test_license_propagation_and_typing(spark):
    paths = spark.createDataFrame([("D", "/LICENSE", "c0", "b0"), ("D", "/lib/COPYING", "c1", "b1"), ("D", "/lib/x.c", "c2", "b2"), ("D", "/src/y.c", "c3", "b3"), ("E", "/z.c", "c4", "b4"), ("E", "/lib/x.c", "c2", "b2")], "directory_id string, path string, content_id string, blob_id string")
    contents = spark.createDataFrame([("b0", ["MIT"]), ("b1", ["GPL-3.0"]), ("b2", []), ("b3", []), ("b4", [])], "blob_id string, licenses array<string>")
    repos = spark.createDataFrame([("D", None, 5, 0, 1, 1), ("E", "MIT", 1, 0, 1, 1)], "directory_id string, gha_license_id string, star_events_count int, fork_events_count int, revision_date int, visit_date int")
    got = {(r["directory_id"], r["path"]): (r["detected_licenses"], r["license_type"]) for r in license_typing.typed_files(paths, contents, repos, ("MIT",)).collect()}
    assert got == {
        ("D", "/LICENSE"): (["MIT"], "permissive"),
        ("D", "/lib/COPYING"): (["GPL-3.0", "MIT"], "non_permissive"),
        ("E", "/lib/x.c"): ([], "permissive"),  # of two copies the permissively licensed one stays
        ("D", "/src/y.c"): (["MIT"], "permissive"),
        ("E", "/z.c"): ([], "permissive"),
    }


def test_repo_merge(spark):
    event = lambda kind, at, rid, name, branch, spdx: {"type": kind, "created_at": at, "repo": {"id": rid, "name": name}, "payload": {("forkee" if kind == "ForkEvent" else "pull_request"): ({"id": rid, "full_name": name, "default_branch": branch, "license": {"spdx_id": spdx}} if kind == "ForkEvent" else {"base": {"repo": {"id": rid, "full_name": name, "default_branch": branch, "license": {"spdx_id": spdx}}}})} if kind in ("ForkEvent", "PullRequestEvent") else None}
    lines = [
        event("WatchEvent", "2020-01-01T00:00:00Z", 1, "a/x", None, None), event("WatchEvent", "2020-01-02T00:00:00Z", 1, "a/x", None, None),
        event("PullRequestEvent", "2020-01-03T00:00:00Z", 1, "a/x", "dev", "MIT"), event("PullRequestEvent", "2020-01-02T00:00:00Z", 1, "a/x", "old", "GPL"),
        event("WatchEvent", "2020-01-01T00:00:00Z", 2, "b/y", None, None),
    ]
    events = spark.createDataFrame([(json.dumps(x),) for x in lines], "j string").select(F.from_json("j", readers.EVENTS).alias("e")).select("e.*")
    assert rows(repo_merge.activity(events), "github_id") == [(1, "a/x", 2, None), (2, "b/y", 1, None)]
    visits = spark.createDataFrame([("https://github.com/a/x", 1, "full", "d1", "s0"), ("https://github.com/a/x", 2, "full", "d2", "s1"), ("https://github.com/a/x", 3, "partial", "d3", "s9"), ("https://github.com/b/y", 1, "full", "d1", "s2"), ("https://else.org/b/y", 1, "full", "d1", "s2")], "origin string, visit long, status string, date string, snapshot string")
    branches = spark.createDataFrame([("s1", bytearray(b"refs/heads/dev"), "revision", "v1"), ("s1", bytearray(b"refs/heads/main"), "revision", "v2"), ("s2", bytearray(b"HEAD"), "revision", "v3"), ("s2", bytearray(b"x"), "release", "v4")], "snapshot_id string, name binary, target_type string, target string")
    revisions = spark.createDataFrame([("v1", "git", "2020", "2020", "dirA"), ("v2", "git", "2021", "2021", "dirB"), ("v3", "git", "2019", "2019", "dirA"), ("v5", "svn", "2019", "2019", "dirC")], "id string, type string, date string, committer_date string, directory string")
    got = repo_merge.merge(events, visits, branches, revisions).collect()
    assert [(r["directory_id"], r["full_name"], r["license_spdx_id"], r["star_events_count"], r["fork_events_count"]) for r in got] == [("dirA", "a/x", "MIT", 2, 0)]


def raw_event(kind, n, login, action, **payload):
    return json.dumps({"type": kind, "public": True, "created_at": f"2020-01-01T00:00:{n:02d}Z", "actor": {"login": login}, "repo": {"name": "o/r"}, "payload": {"action": action, **payload}})


def pull(merged=False, head="h1", base="b1"):
    return {"url": "https://api.host/repos/o/r/pulls/3", "merged": merged, "created_at": "2019-12-31T00:00:00Z", "title": "A long enough title", "body": "The description of this change", "user": {"login": "ann"}, "head": {"sha": head, "repo": {"full_name": "o/r"}}, "base": {"sha": base, "repo": {"full_name": "o/r"}}}


def sample_events(spark):
    link = {"url": "https://api.host/repos/o/r/pulls/3"}
    lines = [
        raw_event("PullRequestReviewEvent", 5, "bob", "created", pull_request=pull(), review={"id": 7, "body": "hm", "state": "commented", "user": {"type": "User"}}),
        raw_event("PullRequestReviewEvent", 6, "bob", "created", pull_request=pull(), review={"id": 7, "body": "fine with me", "state": "approved", "user": {"type": "User"}}),
        raw_event("PullRequestReviewEvent", 7, "cy[bot]", "created", pull_request=pull(base="b2"), review={"id": 8, "body": None, "state": "commented", "user": {"type": "Bot"}}),
        raw_event("PullRequestReviewCommentEvent", 8, "bob", "created", pull_request=pull(head="h2"), comment={"id": 9, "body": "please rename this, ann, thanks", "path": "a.py", "original_position": 1, "diff_hunk": "@@ -3,1 +3,1 @@\n-x\n+y"}),
        raw_event("IssueCommentEvent", 9, "dan", "created", issue={"id": 3, "number": 3, "pull_request": link, "title": "t", "body": "issue text", "created_at": "2019", "user": {"login": "ann"}}, comment={"id": 1, "body": "a comment of some length here"}),
        raw_event("PullRequestEvent", 10, "ann", "closed", pull_request=pull(merged=True, head="h2")),
        raw_event("IssueCommentEvent", 1, "dan", "created", issue={"id": 50, "number": 5, "title": "bug", "body": "it breaks", "created_at": "2018", "user": {"login": "eve"}}, comment={"id": 2, "body": "me too"}),
        raw_event("IssuesEvent", 2, "eve", "closed", issue={"id": 50, "number": 5, "title": "bug", "body": "it breaks", "created_at": "2018", "user": {"login": "eve"}}),
        raw_event("PushEvent", 2, "eve", None),
        raw_event("IssueCommentEvent", 2, "eve", "created", issue={"id": 60, "number": 6, "pull_request": {"url": "https://api.host/repos/o/r/pulls/6"}}, comment={"id": 4, "body": "alone"}),
    ]
    return spark.createDataFrame([(x,) for x in lines], "j string").select(F.from_json("j", histories.RAW).alias("e")).select("e.*")


def test_histories(spark):
    issues, pulls = histories.routed(histories.flat_events(sample_events(spark)))
    one = histories.issue_histories(issues).first()
    assert [(e["type"], e["action"], e["author"], e["text"]) for e in one["events"]] == [("issue", "opened", "eve", "it breaks"), ("comment", "created", "dan", "me too"), ("issue", "closed", "eve", None)]
    shown = histories.issue_histories(issues).select(histories.issue_text()).first()[0]
    assert "ISSUE OPENED [2018] BY eve" in shown and "COMMENT CREATED" in shown
    got = histories.pull_histories(pulls).collect()
    assert [r["pull_guid"] for r in got] == ["o/r/pull/3"]  # a group of issue events only goes
    events = got[0]["events"]
    assert [e["type"] for e in events][:2] == ["PullRequestEvent", "PullRequestReviewEvent"] and events[0]["action"] == "opened"
    assert (events[0]["actor_login"], events[0]["title"], events[0]["created_at"]) == ("ann", "A long enough title", "2019-12-31T00:00:00Z")
    s = histories.with_stats(histories.pull_histories(pulls)).first()
    assert (s["review_n_approved"], s["review_n_commented"], s["review_n_other"]) == (1, 1, 0)
    assert (s["n_pre"], s["n_cre"], s["n_cre_bot"], s["n_ie"], s["is_merged"], s["n_rebases"], s["n_commit_pairs"]) == (2, 4, 1, 1, 1, 0, 3)
    assert (s["n_non_bot_users"], s["n_bot_users"], s["is_bot_opened"], s["is_closed"], s["pr_title_len"]) == (3, 1, 0, 1, 19)
    assert histories.discussed(histories.with_stats(histories.pull_histories(pulls))).count() == 1


def test_opt_outs(spark):
    pulls = histories.pull_histories(histories.routed(histories.flat_events(sample_events(spark)))[1])
    users = lambda *u: spark.createDataFrame([(x,) for x in u], "user string")
    assert histories.without_users(pulls, users("ann")).count() == histories.without_users(pulls, users("o")).count() == 0
    kept = histories.without_users(pulls, users("bob", "zed")).first()["events"]
    assert {e["actor_login"] for e in kept} == {"ann", "cy[bot]", "dan"}
    scopes = spark.createDataFrame([("a", ["all", "x/y"]), ("b", ["Commits"]), ("c", ["GitHub issue", "p/q"])], "user string, scopes array<string>")
    got = {(r["kind"], r["name"]) for r in joins.opt_out_lists(scopes).collect()}
    assert got == {("user_repos", "a"), ("user_commits", "a"), ("user_issues", "a"), ("user_commits", "b"), ("user_issues", "c"), ("repo", "x/y"), ("repo", "p/q")}
    repos = spark.createDataFrame([("x/y",), ("a/b",), ("c/d",)], "repo_name string")
    assert [r[0] for r in joins.opted_out(repos, spark.createDataFrame([("x/y",)], "repo_name string"), users("a")).collect()] == ["c/d"]


def test_pull_render(spark):
    pulls = histories.pull_histories(histories.routed(histories.flat_events(sample_events(spark)))[1])
    base = "\n".join(f"line {i}" for i in range(60))
    files = lambda head: [("a.py", base, "Python", head)]
    pairs = spark.createDataFrame([("o/r/pull/3", "h1", "b1", files(base.replace("line 30\n", "new 30\n"))), ("o/r/pull/3", "h2", "b1", files(base.replace("line 31\n", "new 31\n")))], "pull_guid string, head_commit_id string, base_commit_id string, files array<struct<base_path:string,base_content:string,base_language:string,head_content:string>>")
    p = pull_render.Params(randomness=False)
    # two bases less one for the merge leave no rebase
    out = pull_render.render(pulls, pairs, p).first()
    text = out["render"]
    order = [text.index(x) for x in ("<pr>Title: A long enough title\nusername_0: The description", "<pr_status>opened<repo_name>o/r<pr_base><pr_file>a.py<pr_base_code>line 14", "<pr_diff><pr_file>a.py<pr_diff_hunk>@@ -14", "<pr_review>username_1: hm", "<pr_diff_hunk_comment_line>1<pr_diff_hunk>@@", "<pr_comment>username_3: a comment", "<pr_is_merged>True")]
    assert order == sorted(order) and out["length"] == len(text)
    assert text.count("<pr_diff><pr_file>") == 2  # one per new head commit
    assert "please rename this, username_0, thanks" in text
    assert out["languages"][0]["language"] == "Python"
    assert pull_render.render(pulls, pairs.filter("head_commit_id = 'h2'"), p).count() == 0  # no initial diff


def test_commit_pairs(spark):
    f = "array<struct<path:string,content:string,language:string>>"
    same = "\n".join("x = 1" for _ in range(9))
    data = [
        ("g1", "h", "a/x", [("p", same, "Python"), ("only", "z", "C")], [("p", same + "\ny = 2", "Python"), ("p", same + "\ny = 3", "Python")]),
        ("g2", "h", "a/x", [("p", "q", "C")], [("other", "q", "C")]),
        ("g3", "h", "b/x", [("p", same, "C")], [("p", "y", "C")]),
        ("g4", "h", "out/x", [("p", same, "C")], [("p", "y", "C")]),
        ("g5", "h", "a/x", [("p", "####", "C")], [("p", "y", "C")]),
        ("g6", "h", "a/x", [("p", "w" * 50, "C")], [("p", "y", "C")]),
        ("g7", "h", "none/x", [("p", same, "C")], [("p", "y", "C")]),
    ]
    pairs = spark.createDataFrame(data, f"pull_guid string, head_commit_id string, repo_name string, base_files {f}, head_files {f}")
    licenses = spark.createDataFrame([("a/x", "permissive"), ("b/x", "non_permissive"), ("out/x", "no_license")], "repo_name string, license_type string")
    steps = commit_pairs.prepared(pairs, licenses, spark.createDataFrame([], "repo_name string"), spark.createDataFrame([("out",)], "user string"), most_changes=40)
    assert [r["n_rows"] for r in commit_pairs.funnel(steps).orderBy("position").collect()] == [7, 5, 4, 3, 2, 1]
    last = steps["valid"].first()
    assert last["pull_guid"] == "g1" and last["files"][0]["head_content"].endswith("y = 3") and len(last["files"]) == 1
    listed = joins.without_listed(steps["valid"].withColumn("files", F.transform("files", lambda x: F.struct(x["base_language"].alias("base_language"), F.lit("d/a.py").alias("base_path")))), "files", [("Python", "py")])
    assert listed.count() == 0


def test_notebook_segments_and_script(spark):
    cells = [
        {"cell_type": "markdown", "source": ["A"]}, {"cell_type": "markdown", "source": "B"}, {"cell_type": "code", "source": "x = 1", "outputs": [{"text": ["o\n"]}]},
        {"cell_type": "code", "source": ["y = 2\n", "%magic"], "outputs": []}, {"cell_type": "code", "source": "def z():\n    return 3"}, {"cell_type": "code", "source": ""}, {"cell_type": "markdown", "source": "end"},
    ]
    table = [{"data": {"text/html": "<table><tr><th>h</th></tr><tr><td>v</td></tr></table>", "text/plain": "no"}}, {"data": {"image/png": "xx", "text/plain": "seen"}}]
    books = spark.createDataFrame([("n1", json.dumps(cells)), ("n2", "broken"), ("n3", json.dumps(cells[:2] * 3)), ("n4", json.dumps([{"cell_type": "code", "source": "a", "outputs": table}] * 4))], "file_id string, content string")
    made = notebooks.cells_of(books)
    got = {r["file_id"]: r for r in made.withColumn("s", notebooks.segments(F.col("cells"))).withColumn("script", notebooks.script(F.col("cells"))).withColumn("told", notebooks.script(F.col("cells"), True)).collect()}
    assert [(s["cell_type"], s["input"], s["output"]) for s in got["n1"]["s"]] == [("markdown", "A\nB", "<empty>"), ("code", "x = 1", "o"), ("code", "y = 2\n%magic\ndef z():\n    return 3", "<empty>"), ("markdown", "end", "<empty>")]
    assert got["n1"]["script"] == "\n# A\n# B\nx = 1\ny = 2\ndef z():\n    return 3\n\n"
    assert '"""Example Output:\no\n"""' in got["n1"]["told"] and got["n2"]["cells"] is None and got["n3"]["script"] == ""
    assert got["n4"]["cells"][0]["output"] == "| h |\n| --- |\n| v |seen"
    steps = notebooks.scripts(spark.createDataFrame([("n", json.dumps([{"cell_type": "code", "source": "x = 1\n" * 30}] * 4)), ("m", json.dumps([{"cell_type": "code", "source": "x = = 1\n" * 30}] * 4))], "file_id string, content string"))
    assert [df.count() for df in steps.values()] == [2, 2, 1]
    code = spark.createDataFrame([("%m\nimport pandas as pd\npd.read_csv(' ../input/a/b.csv ')\npd.read_csv(x)",), ("1 +",)], "c string")
    found = [r[0] for r in code.select(notebooks.read_csv_paths(F.col("c"))).collect()]
    assert found == [["../input/a/b.csv"], []]
    assert code.select(notebooks.dataset_paths(F.array(F.lit("../input/a/b.csv"), F.lit("../input/a/b.csv"), F.lit("x")))).first()[0] == ["a/b.csv"]


def test_instruction_texts(spark):
    df = spark.createDataFrame([("Q", "def f():", '{"fn_name": "f"}', '["s1", "s2"]'), ("Q", "", "", "broken")], "q string, s string, t string, a string")
    got = [r[0] for r in df.select(instruct.exercise_prompt(*map(F.col, "qsta"))).collect()]
    assert got == ["\nQUESTION:\nQdef f():\nUse Call-Based format\nANSWER:\ns1", "\nQUESTION:\nQ\nUse Standard Input format\nANSWER:\n"]
    c = spark.createDataFrame([(["a", "b", "c"], [1, 1, 2])], "s array<string>, l array<int>").select(instruct.first_per_language(F.col("s"), F.col("l")).alias("f"))
    assert c.select(instruct.contest_text(F.lit("D"), F.col("f"))).first()[0] == "D\nSolution (Python 2):a\nSolution (CPP):c"
    d, f, t = instruct.math_file(F.lit("x/train-easy/algebra__linear.txt"))
    assert tuple(spark.range(1).select(d, f, t).first()) == ("easy", "algebra", "linear")


def test_compilers(spark):
    files = spark.createDataFrame([("a", "ok", "x"), ("b", "half", "x"), ("c", "zz", "x"), ("d", "gone", None)], "source string, extension string, code string")
    got = compiled.compile_files(files, {"ok": ("cp {src} {out}", "true"), "half": ("true", "false"), "gone": ("no-such-compiler {src}", "true")})
    assert rows(got.select("source", "perf_status", "size_status", "perf_out"), "source") == [("a", 0, 0, "x"), ("b", 0, 1, None), ("c", -1, -1, None), ("d", -1, 0, None)]
    assert tuple(compiled.summary(got).first()) == (4, 2, 2, 1, 0.25)


def test_ranks_and_slices(spark):
    df = spark.range(100).select((F.col("id") * 3).alias("k")).repartition(5)
    assert [r["k"] for r in dedup.with_rank(df, ["k"]).orderBy("__rank").collect()] == [3 * i for i in range(100)]
    parts = [sorted(r["k"] // 3 for r in dedup.slice_of(df, ["k"], i, 3).collect()) for i in range(3)]
    assert parts == [list(range(33)), list(range(33, 66)), list(range(66, 100))]
    rates = spark.createDataFrame([(1,), (1000,), (2000,)], "n int").select(dedup.repo_rate(F.col("n"))).collect()
    assert [round(r[0], 4) for r in rates] == [0.8, 0.1007, 0.05]


def test_first_match_and_full_outer(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    hop = spark.createDataFrame([(1, "z"), (1, "b")], "k2 int, v string")
    assert rows(joins.first_match_chain(a, [(hop, "k", "k2", {"v": "v"})]), F.col("k").asc_nulls_last()) == [(1, "b"), (2, None), (None, None)]
    both = joins.full_outer_once(spark.createDataFrame([(1, "l"), (2, "l")], "k int, l string"), spark.createDataFrame([(2, "r"), (3, "r"), (3, "r")], "k int, r string"), "k")
    assert rows(both, "k") == [(1, "l", None), (2, "l", "r"), (3, None, "r")]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "j").mkdir()
    with gzip.open(tmp_path / "j/a.json.gz", "wt") as f:
        f.write('{"query": "q", "response": "r"}\nbroken\n{"query": "q2", "response": "r2"}\n')
    (tmp_path / "j/b.json.gz").write_bytes(b"not gzip")
    (tmp_path / "j/c.txt").write_text("other")
    assert sorted(r[0] for r in readers.query_responses(spark, str(tmp_path / "j")).collect()) == ["q\nr", "q2\nr2"]
    (tmp_path / "b").mkdir()
    (tmp_path / "b/k1.gz").write_bytes(gzip.compress(b"hello"))
    (tmp_path / "b/k2.gz").write_bytes(gzip.compress(b"a\0b"))
    (tmp_path / "b/k3.gz").write_bytes(b"broken")
    records = spark.createDataFrame([(k, 1, None) for k in ("k1", "k2", "k3", "k4")], "blob_id string, length long, content string")
    assert rows(readers.blobs(spark, str(tmp_path / "b"), records).select("blob_id", "content"), "blob_id") == [("k1", "hello"), ("k2", None), ("k3", None), ("k4", None)]
    (tmp_path / "m/train-easy").mkdir(parents=True)
    (tmp_path / "m/train-easy/f__t.txt").write_text("q1\na1\nq2\na2\nodd\n")
    assert rows(readers.alternate_lines(spark, str(tmp_path / "m")).select("n", "content"), "n") == [(0, "q1\na1"), (1, "q2\na2")]
    (tmp_path / "nb/x").mkdir(parents=True)
    (tmp_path / "nb/x/12.ipynb").write_text('{"cells": [{"cell_type": "code", "source": "x"}]}')
    (tmp_path / "nb/x/13.ipynb").write_text("broken")
    assert [r["file_id"] for r in readers.notebooks(spark, str(tmp_path / "nb")).collect()] == ["12"]
    (tmp_path / "c.csv").write_text('Id,Slug\n1,"a ""b"""\n')
    assert rows(readers.csv_table(spark, str(tmp_path / "c.csv"), "Id int, Slug string"), "Id") == [(1, 'a "b"')]
    times = spark.createDataFrame([("2020-01-01 00:00:00",)], "t string").select(F.to_timestamp("t").alias("t"), F.lit(1).alias("x"))
    times.write.orc(str(tmp_path / "o"))
    times.unionByName(times.withColumn("t", F.timestamp_seconds(F.lit(300_000_000_000)))).write.mode("overwrite").orc(str(tmp_path / "o"))
    assert sorted(str(r[0]) for r in readers.orc_with_timestamps(spark, str(tmp_path / "o")).select(F.year("t"), "x").collect()) == ["2020", "None"]
    df = spark.createDataFrame([(1, "a", "xx"), (2, "b", "yyy")], "k int, p string, t string")
    sinks.parquet(df, str(tmp_path / "p"), 2)
    assert readers.with_stem(spark.read.parquet(str(tmp_path / "p")), ["k"]).select("stem").distinct().count() == 2
    sinks.gzip_json(df, str(tmp_path / "g"), ["p"])
    assert readers.json_records(spark, str(tmp_path / "g"), "k int, t string").count() == 2
    sinks.csv(df, str(tmp_path / "cs"))
    assert sinks.sharded(df, str(tmp_path / "s"), "t", 2) == 3 and spark.read.parquet(str(tmp_path / "s")).count() == 2
    assert [r["k"] for r in sinks.unfinished(df, df.filter("k = 1"), ["k"]).collect()] == [2]
    sinks.gzip_json(spark.createDataFrame([("b1", 5), ("b2", 20 << 20)], "blob_id string, length long"), str(tmp_path / "f"))
    assert [(r["blob_id"], r["licenses"]) for r in readers.file_records(spark, str(tmp_path / "f")).collect()] == [("b1", None)]
    assert readers.archive_grid(spark, "2015-01-01", "2023-07-26").count() == 3129 * 24
