import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltmill.llm import rule_ledger as r
from siltmill.llm import url_automaton as u


def brute_measures(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + d for i, g in enumerate(grams) if grams.count(g) > 1 for d in range(3)}
    repeats = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeats, len(covered), len(lines)


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="ab# \n\t\xa0\x1cé😀|", max_size=60)))
def test_measures_match_brute_force(text):
    assert r.measure_text(text) == brute_measures(text)


SCHEMA = "doc_id long, text string, n_words string, fail_bits string"


def test_ledger_edges_and_policies(spark):
    rows = [(1, None, "x", "y"), (2, "", "x", "y"), (None, "a b", "x", "y"), (3, "w " * 60, "x", "y"), (3, "w " * 60, "x", "y"), (4, " ".join(f"word{i}" for i in range(60)), None, None), (5, "é " + "x" * 200_000, None, None)]
    book = r.verdicts(r.ledger(spark.createDataFrame(rows, SCHEMA)))
    got = {(x["doc_id"], x["n_words"]): x for x in book.collect()}
    assert book.count() == len(rows)
    assert got[1, 0]["fail_bits"] == got[2, 0]["fail_bits"] == r.bits(["too_few_words"])
    assert got[3, 60]["n_repeat_words"] == 60 and not got[3, 60]["kept_base"]
    assert got[4, 60]["kept_v2"] and got[5, 2]["word_chars"] == 200_001
    assert r.ledger(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ablations_are_counts_without_a_rule(spark):
    texts = [random.Random(i).choice(["w " * 60, "# " * 70, "a b c", " ".join(f"word{j}" for j in range(80))]) for i in range(40)]
    book = r.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).cache()
    policy = r.POLICIES[1]
    masks = [x["fail_bits"] for x in book.collect()]
    for row in r.ablations(book, policy).collect():
        rest = r.bits([n for n in policy.rules if n != row["rule"]])
        assert row["n_kept_without"] == sum(m & rest == 0 for m in masks)
        assert row["n_failed"] == sum(bool(m & r.bits([row["rule"]])) for m in masks)


def brute_glob(glob, text):
    if not glob:
        return not text
    if glob[:2] == "**":
        return any(brute_glob(glob[2:], text[i:]) for i in range(len(text) + 1))
    if glob[0] == "*":
        return any(brute_glob(glob[1:], text[i:]) for i in range(len(text) + 1) if "/" not in text[:i])
    return bool(text) and (text[0] != "/" if glob[0] == "?" else text[0] == glob[0]) and brute_glob(glob[1:], text[1:])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab/*?é", max_size=7), min_size=1, max_size=40), st.lists(st.text(alphabet="ab/é😀", max_size=9), max_size=8))
def test_automaton_matches_brute_force(globs, texts):
    hits = u.GlobAutomaton(globs).match(texts)
    assert hits.tolist() == [[brute_glob(g, t) for g in globs] for t in texts]


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
        ("http://a.example.net/fr/x", "a.example.net", "/fr/x", "net/", "block"),
        ("https://notexample.net/en/x", "notexample.net", "/en/x", "net/", "block"),
        ("https://evil.com/x.net/y", "evil.com", "/x.net/y", None, "allow"),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        ("http://x.org/fr/spam", "x.org", "/fr/spam", "org/fr/", "allow"),
        ("http://x.net", "x.net", "", None, "allow"),
        ("http://x.net?a=/", "x.net", "", None, "allow"),
        ("https://spam-farm.example.org/en/", "spam-farm.example.org", "/en/", None, "block"),
        ("https://x.org/spam/", "x.org", "/spam/", None, "allow"),
        ("nonsense", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://É.net/", "É.net", "/", "net/", "block"),
        ("http://x.org/" + "a" * 50_000, "x.org", "/" + "a" * 50_000, None, "allow"),
    ],
)
def test_url_judgements(url, host, path, rule, verdict):
    got = u.judge([url, "http://a.b/c"], u.RULES, u.GlobAutomaton([x.glob for x in u.RULES])).iloc[0]
    assert (got["host"], got["path"], got["rule"], got["verdict"]) == (host, path, rule, verdict)


def test_url_filter_on_tables(spark):
    rows = [(1, None, "h"), (None, "http://a.net/", "h"), (2, "http://a.net/", "h"), (2, "http://a.net/", "h")]
    assert u.filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string")).count() == 4
    assert u.filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
