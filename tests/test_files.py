import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from siltmill.operators import file_language as fl
from siltmill.operators import passages as ps
from siltmill.operators import path_labels as pl
from siltmill.queries import files as queries

SF = "/root/testdata/sf0.001"


def prints_by_hand(text, width=3, window=3):
    words = re.findall(ps.WORDS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    mark = lambda w: hashlib.md5(" ".join(w).encode()).hexdigest()[:16]
    grams = [mark(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))]
    return {min(grams[i : i + window]) for i in range(max(len(grams) - window + 1, 1))}


MIT = dict(ps.LICENSE_TEXTS)["MIT"]
TEXTS = [(1, None), (2, ""), (3, "?! ..."), (4, "one two"), (5, MIT), (6, "Before it. " + MIT.upper() + " After it."), (7, MIT.replace("Software", "Program")), (8, "word " * 20_000 + MIT), (None, "Released under the MIT License.")]


def test_fingerprints(spark):
    df = spark.createDataFrame(TEXTS, "id long, text string")
    for r in df.select("text", ps.fingerprints(F.col("text")).alias("p")).collect():
        assert len(r.p) == len(set(r.p)) and set(r.p) == prints_by_hand(r.text)


@pytest.mark.parametrize("most_broadcast", [0, 10_000])
def test_exact_and_edited_passages_are_held(spark, most_broadcast):
    texts = spark.createDataFrame([(*r, "x", "y") for r in TEXTS], "id long, text string, ref string, body string")
    refs = spark.createDataFrame([*ps.LICENSE_TEXTS, ("notice", "Released under the MIT License."), ("none", None), ("empty", "-")], "ref string, body string")
    got = {(r.id, r.ref): r.shared / r["of"] for r in ps.held_passages(texts, refs, "id", "text", "ref", "body", most_broadcast=most_broadcast).collect()}
    want = {}
    for i, text in TEXTS:
        for ref, body in [*ps.LICENSE_TEXTS, ("notice", "Released under the MIT License.")]:
            part = len(prints_by_hand(text) & prints_by_hand(body)) / len(prints_by_hand(body))
            if part >= 0.5:
                want[i, ref] = part
    assert got == pytest.approx(want)
    assert got[5, "MIT"] == got[6, "MIT"] == got[8, "MIT"] == got[None, "notice"] == 1 and 0.5 < got[7, "MIT"] < 1
    assert ps.held_passages(texts.limit(0), refs, "id", "text", "ref", "body").count() == ps.held_passages(texts, refs.limit(0), "id", "text", "ref", "body").count() == 0


def test_only_license_files_have_licenses(spark):
    rows = [(1, ["src/main.py", "LICENSE.txt"], MIT), (2, ["main.py"], MIT), (3, ["COPYING"], "Nothing of the kind is said here."), (4, None, MIT), (None, ["NOTICE"], MIT + "\n" + dict(ps.LICENSE_TEXTS)["ISC"]), (6, ["LICENSE"], None)]
    files = spark.createDataFrame(rows, "blob_id long, filenames array<string>, content string")
    refs = spark.createDataFrame([*ps.LICENSE_TEXTS, *ps.NOTICES], "license string, text string")
    assert {r.blob_id: r.licenses for r in ps.file_licenses(files, refs).collect()} == {1: ["MIT"], 2: [], 3: [], 4: [], None: ["ISC", "MIT"], 6: []}


NAMES = [
    ("a/b/Makefile", "x", "name", ["Makefile"]),
    ("go.mod", None, "name", ["Go Module"]),
    ("run", "#!/usr/bin/python3.9\nx", "first_line", ["Python"]),
    ("run", "#! /usr/bin/env -S -i bash -e", "first_line", ["Shell"]),
    ("x.py", "#!/bin/sh", "first_line", ["Shell"]),
    ("A.PY", "", "suffix", ["Python"]),
    ("lib.h", "int x;", "suffix", ["C", "C++", "Objective-C"]),
    (".py", "", None, None),
    ("dir.py/file", "", None, None),
    ("x.unknown", "#!nothing-known", None, None),
    (None, None, None, None),
    ("", "", None, None),
]


def test_cascade(spark):
    df = spark.createDataFrame([(i, n, t) for i, (n, t, _, _) in enumerate(NAMES)], "i int, name string, content string")
    got = {r.i: (r.c.how, r.c.candidates) if r.c else (None, None) for r in df.select("i", fl.cascade(F.col("name"), F.col("content")).alias("c")).collect()}
    assert got == {i: (how, c) for i, (_, _, how, c) in enumerate(NAMES)}


def test_tokens_decide_as_by_hand(spark):
    c, objc = "#include <x>\nint main(void) { return x; }", "#import <X.h>\n@interface A : NSObject\n@end [self run]"
    rows = [("a.c", c), ("b.c", c + " struct s;"), ("a.cpp", "std::vector<int> v; template <class T> " * 20), ("o.h", objc), ("c.h", "int f(void);"), ("p.h", "std::string s; template <class T> void g();"), ("q.h", None), ("n.pl", "x :- y."), ("m.py", "import x"), (None, "int"), ("c.h", "int f(void);")]
    seen = spark.createDataFrame([(*r, "zz") for r in rows], "name string, content string, how string")
    # objective-c is taught by a name rule of its own here
    rules = fl.Rules({**fl.SOURCE_RULES.names, "O.h": "Objective-C"}, fl.SOURCE_RULES.interpreters, fl.SOURCE_RULES.suffixes)
    taught = seen.unionByName(spark.createDataFrame([("O.h", objc, "")], seen.schema))
    got = [(r.name, r.language, r.how) for r in fl.identify(taught, rules=rules).collect()]
    tokens = lambda x: [zlib.crc32(t) % fl.BUCKETS for t in re.findall(rb"[^\W\d]+|[^\w\s]", (x or "").encode())]
    counts, n = defaultdict(Counter), Counter()
    for name, text in [*rows, ("O.h", objc)]:
        language = {"a.c": "C", "b.c": "C", "a.cpp": "C++", "m.py": "Python", "O.h": "Objective-C"}.get(name)
        if language:
            counts[language].update(tokens(text))
            n[language] += 1
    score = lambda lang, text: math.log(n[lang] / sum(n.values())) + sum(math.log((counts[lang][t] + 1) / (sum(counts[lang].values()) + fl.BUCKETS)) for t in tokens(text))
    for name, text in rows:
        if name and name.endswith(".h"):
            best = max(sorted(["C", "C++", "Objective-C"]), key=lambda x: score(x, text))  # noqa: B023
            assert (name, best, "tokens") in got
    assert {x for x in got if x[0] in ("o.h", "p.h", "n.pl", None)} == {("o.h", "Objective-C", "tokens"), ("p.h", "C++", "tokens"), ("n.pl", "Perl", "tokens"), (None, None, None)}
    assert len(got) == 12 and fl.identify(taught.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_open_documents_get_their_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.file_languages(spark, SF).join(docs, "doc_id").filter("how = 'tokens'").collect()
    assert len(got) > 20 and sum(r.language == r.lang for r in got) >= 0.95 * len(got)


PATHS = {
    "a/node_modules/x/y.js": ["vendored"],
    "node_modules": [],
    "dist/a.js": ["vendored"],
    "src/dist/a.js": [],
    ".yarn/releases/x": ["vendored"],
    "a/jquery.min.js": ["vendored"],
    "api_pb2.py": ["generated"],
    "vendor/api.pb.go": ["generated", "vendored"],
    "a/package-lock.json": ["generated"],
    "main.py": [],
    "": [],
}


@pytest.mark.parametrize("as_table", [False, True])
def test_paths_meet_their_rules(spark, as_table):
    rules = spark.createDataFrame(list(pl.FILE_RULES), "label string, kind string, pattern string") if as_table else pl.FILE_RULES
    paths = spark.createDataFrame([(p,) for p in [*PATHS, None, "main.py"]], "path string")
    assert {r.path: r.labels for r in pl.labelled_paths(paths, rules).collect()} == {p: x for p, x in PATHS.items() if x}


def test_shapes_of_lines(spark):
    texts = [None, "", "a", "a\n", "ab\n\ncdef", "# Code generated by x. DO NOT EDIT.\nx", "\n\n\n\n\n@generated", "x" * 500]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [tuple(r.s) for r in df.select("i", pl.line_shape(F.col("t")).alias("s")).orderBy("i").collect()]
    assert got == [(0, 0, 0.0, False), (0, 0, 0.0, False), (1, 1, 1.0, False), (2, 1, 0.5, False), (3, 4, 2.0, False), (2, 35, 18.0, True), (6, 10, 10 / 6, False), (1, 500, 500.0, False)]


def test_files_are_labelled_by_path_lines_and_density(spark):
    rows = [("lib/a.js", "x" * 300), ("lib/b.js", "x;\n" * 100), ("lib/a.py", "x" * 300), ("vendor/a.py", "x"), ("z.py", "# autogenerated\n"), (None, None), ("z.py", "# autogenerated\n")]
    files = spark.createDataFrame([(i, *r, ["k"]) for i, r in enumerate(rows)], "i int, path string, content string, labels array<string>")
    got = {r.i: (r.is_vendor, r.is_generated) for r in pl.labelled_files(files.drop("labels")).collect()}
    assert got == {0: (False, True), 1: (False, False), 2: (False, False), 3: (True, False), 4: (False, True), 5: (False, False), 6: (False, True)}
