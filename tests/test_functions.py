import difflib
import re

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltmill.functions import bots, content, licenses, text, values
from siltmill.operators import diffs, joins
from siltmill.operators.notebooks import markdown_of


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


CLA = "LicenseRef-scancode-generic-cla"
UNKNOWN = licenses.UNKNOWN_REFERENCE


@pytest.mark.parametrize(
    ("repo", "found", "kind"),
    [
        ("MIT", ["GPL-3.0"], "permissive"),
        ("GPL-3.0", ["MIT"], "non_permissive"),
        (None, [], "no_license"),
        ("NOASSERTION", [], "non_permissive"),
        (None, ["MIT"], "permissive"),
        ("NOASSERTION", ["MIT", CLA], "permissive"),
        (None, ["MIT", UNKNOWN], "permissive"),
        (None, [UNKNOWN], "non_permissive"),
        (None, [CLA], "no_license"),
        (None, ["MIT", "GPL-3.0"], "non_permissive"),
        (None, None, "no_license"),
    ],
)
def test_license_types(spark, repo, found, kind):
    df = spark.createDataFrame([(repo, found)], "repo string, found array<string>")
    assert df.select(licenses.license_type(F.col("repo"), F.col("found"), ("MIT", "Apache-2.0"))).first()[0] == kind


def test_license_files(spark):
    names = ["LICENSE", "license.txt", "COPYING3", "MIT-LICENSE.md", "main.py", "gpl-3.0.txt", "permit.c", "al2.0", "aboutness", "unlicense"]
    assert apply(spark, names, licenses.is_license_file) == [True, True, True, True, False, True, False, True, False, True]


def test_bots(spark):
    names = [None, "x[bot]", "abbot", "my-ci", "Jenkins", "jenkins-x", "alice", "SparkQA"]
    assert apply(spark, names, bots.is_bot_name) == [True, True, True, True, False, True, False, True]
    df = spark.createDataFrame([("PullRequestReviewEvent", "User", "abbot"), ("PullRequestReviewEvent", "Bot", "alice"), ("PullRequestReviewEvent", None, "abbot"), ("PullRequestEvent", "User", "abbot")], "t string, u string, n string")
    assert [r[0] for r in df.select(bots.is_bot(F.col("t"), F.col("u"), F.col("n"))).collect()] == [False, True, True, True]


def test_markup_comments(spark):
    assert apply(spark, ["a<!-- c --> b <!-- unclosed", "x --> y", "", None], text.drop_markup_comments) == ["a b  unclosed", " y", "", None]


def test_truncation(spark):
    short, long = "\n".join(map(str, range(1, 81))), "\n".join(map(str, range(1, 82)))
    got = apply(spark, [short, long], text.truncate_lines)
    assert got[0] == short
    assert got[1].split("\n") == [*map(str, range(1, 61)), "[TRUNCATED]", *map(str, range(62, 82))]


def reply_by_lines(t):
    """The line rules on a text that fits no whole pattern."""
    lines = t.strip().split("\n")
    start, end = 0, -1
    for i, raw in enumerate(lines):
        line = raw.strip()
        if "notifications@github.com" in line or re.search(text.MAIL_DATE, line):
            start = i
        if "Reply to this email directly" in line:
            end = i + (1 if line.endswith(":") else 0)
        if line.startswith(">"):
            end = i
    return re.sub("_{20,}", "", "\n".join(lines[:start] + lines[end + 1 :])).strip()


REPLIES = ["a\nb notifications@github.com c\nd", "> q\nr", "x", "a\n> q\nb\n" + "_" * 25, "1/2/2020 10:11 AM x wrote\nmine", "hi\nReply to this email directly:\nfoot\nrest", ""]


def test_mail_lines(spark):
    assert apply(spark, REPLIES, text.strip_mail) == [reply_by_lines(t) for t in REPLIES]
    assert reply_by_lines(REPLIES[0]) == "a\na\nb notifications@github.com c\nd"
    assert apply(spark, REPLIES[:2], lambda c: text.strip_mail(c, strict=True)) == ["a\nb notifications@github.com c\nd", "r"]


def test_mail_patterns(spark):
    whole = "thanks!\nFrom: a <notifications@github.com>\nx\nReply to this email directly, view it on GitHub, or mute.\nmore"
    assert apply(spark, [whole, "fix\nSigned-off-by: a b <a@b.c>\nrest", None], text.strip_mail) == ["thanks!", "fix\nrest", ""]


def test_anonymised(spark):
    df = spark.createDataFrame([("bob met al and bobby", ["al", None, "bob", "al"])], "t string, n array<string>")
    assert df.select(text.anonymised(F.col("t"), F.col("n"))).first()[0] == "username_1 met username_0 and username_1by"


def test_hunk_headers(spark):
    got = apply(spark, ["@@ -10,3 +12,4 @@ def f", "@@ -10 +12 @@", "@@ -3,1 +9 @@", "none"], lambda c: text.shifted_hunk(c, F.lit(5)))
    assert got == ["@@ -5,3 +7,4 @@ def f", "@@ -5 +7 @@", None, None]


def test_cleaning(spark):
    assert apply(spark, ["<b>a</b>\r\n\n\nb", "Thank You all"], text.clean_markdown) == ["a\nb", ""]
    code = "%magic\n\n  !ls\nx = 1\npip install y\n# Copyright (C) z\n" + "y" * 601 + "\nz = 2"
    assert apply(spark, [code], text.clean_code) == ["x = 1\nz = 2"]
    assert apply(spark, ["../input/a/b.csv", "/kaggle/input/x/y/z.csv", "../input/b.csv", None], text.csv_path) == ["a/b.csv", "x/y/z.csv", None, None]
    assert apply(spark, ["<pr>a<pr_base>b"], lambda c: text.split_before(c, ("<pr>", "<pr_base>"))) == [["<pr>a", "<pr_base>b"]]
    assert apply(spark, ["x", " a.b(1) ", "for", "a b", ""], text.is_identifier) == [True, True, False, False, False]
    assert apply(spark, ["a/b.tar.gz", "x/.rc", "noext"], text.suffix) == ["gz", "", ""]
    assert apply(spark, [bytearray(b"ab\xff"), bytearray(b"ok")], text.utf8_text, "binary") == ["ab�", "ok"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aé1 \n\r\\x_ ", max_size=30), min_size=1, max_size=6))
def test_content_stats_match_plain_python(spark, texts):
    got = apply(spark, texts, content.content_stats)
    for t, s in zip(texts, got):
        lengths = [len(x) for x in t.splitlines()]
        assert s["num_lines"] == len(lengths) and s["max_line_length"] == max(lengths, default=0)
        assert s["alphanum_fraction"] == pytest.approx(sum(c.isalnum() for c in t) / max(len(t), 1))
        assert s["alpha_fraction"] == pytest.approx(sum(c.isalpha() for c in t) / max(len(t), 1))
        assert s["hex_fraction"] == pytest.approx(2 * t.count("\\x") / max(len(t), 1))
        assert s["avg_line_length"] == pytest.approx(sum(lengths) / max(len(lengths), 1))


def test_valid_files(spark):
    good, bad = "x = 1\ny = 2", "####"
    df = spark.createDataFrame([([(good, "Python"), (bad, "Python")],), ([(bad, "C")],), ([("x " * 900, "Markdown"), ("to the end of it", "Markdown"), ("z" * 2000, "C")],)], "f array<struct<base_content:string,base_language:string>>")
    kept = [r[0] for r in df.select(content.valid_files(F.col("f"))).collect()]
    assert [[f["base_content"] for f in k] if k else None for k in kept] == [[good], None, ["to the end of it"]]


PATHS = st.lists(st.sampled_from(["a", "ab", "b", "c.py"]), min_size=1, max_size=4).map(lambda p: "/" + "/".join(p))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(PATHS, min_size=1, max_size=8), st.lists(PATHS.map(lambda p: p.rsplit("/", 1)[0] + "/"), min_size=1, max_size=6, unique=True))
def test_prefix_join_is_starts_with(spark, paths, bases):
    left = spark.createDataFrame([(1, i, p) for i, p in enumerate([*paths, "none"])], "d int, i int, path string")
    right = spark.createDataFrame([(1, b, b) for b in bases], "d int, base string, found string")
    fast = joins.prefix_join(left, right, ["d"], "path", "base").filter("found IS NOT NULL").select("i", "found").collect()
    assert sorted(map(tuple, fast)) == sorted((i, b) for i, p in enumerate(paths) for b in bases if p.startswith(b))
    assert joins.prefix_join(left, right, ["d"], "path", "base").select("i").distinct().count() == len(paths) + 1


def test_line_ranges():
    assert diffs.range_of("a\nb\nc", "a\nx\nc") == (1, 2, 1, 2, 1, 1, 2)
    same = diffs.range_of("a\nb", "a\nb")
    assert same[1] == same[3] == 0 and same[0] > 1 << 60
    assert diffs.range_of(None, "a") == (None,) * 7


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=12), st.lists(st.sampled_from("abc"), max_size=12), st.integers(0, 4))
def test_hunks_patch_base_to_head(base, head, context):
    out = diffs.hunks_of("\n".join(base), "\n".join(head), 0, context, "")
    base, head = "\n".join(base).splitlines(), "\n".join(head).splitlines()
    got, at = [], 0
    for line in out.split("\n") if out else []:
        if line.startswith("@@"):
            start = int(re.match(r"@@ -(\d+)", line)[1]) - 1
            got += base[at:start]
            at = start
        elif line[0] in " -":
            assert base[at] == line[1:]
            got += [line[1:]] if line[0] == " " else []
            at += 1
        else:
            got.append(line[1:])
    assert got + base[at:] == head
    assert (out == "") == (difflib.SequenceMatcher(None, base, head).ratio() == 1.0)


def test_tables_as_markdown():
    html = "<div class='dataframe'><table><tr><th>a</th><th>b|c</th></tr><tr><td>1</td><td>x\ny</td></tr></table><table><tr><td>no</td></tr></table></div>"
    assert markdown_of(html) == "| a | b&#124;c |\n| --- | --- |\n| 1 | x y |"
    assert markdown_of("<p>none</p>") == markdown_of("<table></table>") == "" and markdown_of(None) is None
    wide = "<table><tr>" + "<th>h</th>" * 9 + "</tr>" + ("<tr>" + "<td>v</td>" * 9 + "</tr>") * 9 + "</table>"
    assert markdown_of(wide).count("\n") == 6 and markdown_of(wide).split("\n")[0].count("h") == 5


def test_whole_texts_become_values_of_python_in_parts(monkeypatch):
    seen, whole = [], values.pa.array
    monkeypatch.setattr(values.pa, "array", lambda rows, kind: seen.append(len(rows)) or whole(rows, kind))
    texts = whole([None if i % 9 == 2 else f"x{i}" for i in range(1203)], pa.string())
    got = values.in_parts(lambda a, b: None if a is None else a + b, pa.string(), texts, texts)
    assert got.to_pylist() == [None if x is None else x + x for x in texts.to_pylist()]
    assert sum(seen) == 1203 and max(seen) <= 500
    assert values.in_parts(len, pa.int64(), whole([], pa.string())).to_pylist() == []
