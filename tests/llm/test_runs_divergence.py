from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltmill.llm import periodic_runs, queries, source_divergence


def runs_by_hand(ids):
    found = {}
    for p in range(1, len(ids) // 4 + 1):
        i = 0
        while i + p < len(ids):
            j = i
            while j + p < len(ids) and ids[j] == ids[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_runs_match_every_period_tried(letters):
    rng = np.random.default_rng(letters)
    for n in list(range(0, 40)) + [90, 150]:
        ids = rng.integers(0, letters, n)
        if n > 20:  # a tail that repeats
            a, p = n // 3, 1 + n // 9
            ids[a:] = ids[a + np.arange(n - a) % p]
        assert [tuple(x) for x in periodic_runs.runs_of(ids).tolist()] == runs_by_hand(ids.tolist())


def test_runs_do_not_depend_on_how_pairs_are_dealt(monkeypatch):
    ids = np.tile([0, 1, 0, 2], 60)
    ids[100:130] = 7
    whole = periodic_runs.runs_of(ids).tolist()
    monkeypatch.setattr(periodic_runs, "PAIRS", 32)
    assert periodic_runs.runs_of(ids).tolist() == whole == [list(x) for x in runs_by_hand(ids.tolist())]


def test_hashes_that_collide_are_found_out(monkeypatch):
    ids = np.array([0, 1, 2, 3] * 5 + [4, 5] + [0, 1] * 6)
    true, tried = periodic_runs.Hashes.same, []

    def same(self, at, period, length):
        tried.append(self)
        return np.ones(len(at), bool) if self is tried[0] else true(self, at, period, length)

    monkeypatch.setattr(periodic_runs.Hashes, "same", same)
    assert [tuple(x) for x in periodic_runs.runs_of(ids).tolist()] == runs_by_hand(ids.tolist())
    assert len({id(x) for x in tried}) == 2


def test_find_runs_defined_cases(spark):
    long = "x " * 50_000 + "end"
    rows = [(1, None, "a"), (2, "", "b"), (3, "a b a b a b a b c", "c"), (3, "a b a b a b a b c", "c"), (None, " \n", "d"), (5, long, "e"), (6, "a a a a a", "f"), (7, "a a a a a a a a", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find_runs(docs).collect())
    assert got == [
        (0, 0, [], ""),
        (1, 0, [], ""),
        (2, 0, [], ""),
        (3, 9, [(0, 8, 2)], "a b c"),
        (3, 9, [(0, 8, 2)], "a b c"),
        (5, 50_001, [(0, 50_000, 1)], "x end"),
        (6, 5, [], "a a a a a"),
        (7, 7, [], "a a a a a a a a"),
    ]
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_tails_repeat_for_every_tenth_id(spark):
    import zlib

    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i % 50))) for i in range(300)] + [(None, "a b"), (None, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in queries.with_tails(docs).filter("doc_id is not null").collect()}
    for i in range(300):
        w, h = [f"w{j}" for j in range(i % 50)], zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        assert got[i] == " ".join(w)


def audit_by_hand(rows, least, top):
    import re

    split = lambda x: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    docs = [(lang or "", source or "", split(text)) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df, counts = Counter(), defaultdict(Counter)
        for _, s, words in (d for d in docs if d[0] == lang):
            df.update(set(words))
            counts[s].update(words)
        kept = [t for t in df if df[t] >= least]
        total = sum(counts.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept}  # noqa: E731, B023
        f = lambda p, q: (p - q) ** 2 // (p + q)
        all_p = share(total)
        for s in counts:
            p = share(counts[s])
            pairs = [(o, sum(f(p[t], q[t]) for t in kept)) for o in counts if o != s for q in [share(counts[o])]]
            words = [(t, f(p[t], all_p[t])) for t in kept if counts[s][t] and p[t] > all_p[t]]
            for part, found, n in (("pair", pairs, None), ("term", words, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(found[:n])]
    return sorted(out)


def test_audit_matches_all_terms_summed(spark):
    rng = np.random.default_rng(5)
    rows = [(" ".join(rng.choice(["The", "the", "über", "x1y", "Ärger", "ofen", "Zu"], rng.integers(0, 9))), ["en", "de", None][i % 3], [None, "a", "b", "C"][i % 4]) for i in range(120)]
    rows += [(None, "fr", "only"), ("", "it", "a"), ("?!", "it", "b"), ("one", None, "rare")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, source string, term string, n int")
    for least in (1, 4, 1000):
        got = source_divergence.audit(docs, least_documents=least, top_terms=2).collect()
        assert sorted(tuple(r) for r in got) == audit_by_hand(rows, least, 2)
    assert source_divergence.audit(docs.limit(0)).count() == 0


def test_counts_pass_on_what_they_hold(spark, monkeypatch):
    import pandas as pd

    monkeypatch.setattr(source_divergence, "HELD", 3)
    batch = pd.DataFrame({"lang": "en", "source": "s", "text": [b"a b c d", b"a b", b"e", b""]})
    out = pd.concat(source_divergence._counted(iter([batch])))
    assert len(out) > 6
    assert out.groupby("term")[["n", "docs"]].sum().T.to_dict("list") == {b"": [0, 4], b"a": [2, 2], b"b": [2, 2], b"c": [1, 1], b"d": [1, 1], b"e": [1, 1]}


def test_shares_and_gaps_are_exact_for_counts_beyond_a_long_product(spark):
    many = 5_000_000_000_000
    df = spark.range(1).select(F.lit(many).alias("n"), F.lit(7 * many).alias("total"), F.lit(11).cast("long").alias("terms"))
    p = df.select(source_divergence.share(F.col("n"), F.col("total"), F.col("terms")).alias("p")).first().p
    assert p == 1 + 10**9 * (many + 2) // (7 * many + 22)
