import math
import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltmill.llm import piece_sampling as p

pytestmark = pytest.mark.skipif(not os.path.exists(p.MODEL), reason="no vocabulary file")


@pytest.fixture(scope="module")
def encoder():
    return p.Encoder(p.Vocabulary.load(p.MODEL))


def segmentations(encoder, text):
    v = encoder.v
    ids = {x.decode(): i for i, x in enumerate(v.pieces) if x is not None and not 0 <= i - v.first_byte < 256}

    def split(s):
        if not s:
            yield (), 0.0
            return
        for n in range(1, min(16, len(s)) + 1):
            if s[:n] in ids:
                for rest, w in split(s[n:]):
                    yield (ids[s[:n]], *rest), w + encoder.logw[ids[s[:n]]]
        if s[0] not in ids:
            own = tuple(b + v.first_byte for b in s[0].encode())
            for rest, w in split(s[1:]):
                yield own + rest, w + sum(encoder.logw[b] for b in own)

    found = dict(split(" " + text))
    total = np.logaddexp.reduce(list(found.values()))
    return {k: w - total for k, w in found.items()}


def test_draws_follow_the_distribution_without_replacement(encoder):
    truth = {k: math.exp(w) for k, w in segmentations(encoder, "ab the").items()}
    flat = p.Encoder(encoder.v, alpha=0.2)
    truth = {k: math.exp(w) for k, w in segmentations(flat, "ab the").items()}
    first, pair, third = Counter(), Counter(), Counter()
    n = 4000
    for drawn in flat.draw(["ab the"] * n, [7919 * i * i + i for i in range(n)], 3):
        a, b, c = (tuple(x[0].tolist()) for x in drawn)
        assert len({a, b, c}) == 3
        first[a] += 1
        pair[a, b] += 1
        third[c] += 1
    for s, q in truth.items():
        assert abs(first[s] / n - q) < 0.03
        for s2, q2 in truth.items():
            if s2 != s:
                assert abs(pair[s, s2] / n - q * q2 / (1 - q)) < 0.03
    for c, q in truth.items():
        want = sum(truth[a] * truth[b] / (1 - truth[a]) * q / (1 - truth[a] - truth[b]) for a in truth for b in truth if len({a, b, c}) == 3)
        assert abs(third[c] / n - want) < 0.03


def test_scores_are_those_of_the_lattice(encoder):
    text = "hé the\nab"
    truth = segmentations(encoder, text)
    for drawn in encoder.draw([text] * 40, list(range(40)), 4):
        values = [x[2] for x in drawn]
        assert values == sorted(values, reverse=True)
        for ids, logp, _, inclusion in drawn:
            assert abs(truth[tuple(ids.tolist())] - logp) < 1e-9 and inclusion <= 0


@settings(max_examples=80, deadline=None)
@given(text=st.text(alphabet="ab \n\té▁€😀the", min_size=1, max_size=40), key=st.integers(0, 2**64 - 1))
def test_every_draw_decodes_to_the_text(encoder, text, key):
    drawn = encoder.draw([text, "filler text"], [key, 1], 3)[0]
    assert len({tuple(x[0].tolist()) for x in drawn}) == len(drawn) >= 1
    assert all(encoder.v.decode(x[0].tolist()) == text for x in drawn)


def test_exhausted_lattices_and_batches(encoder):
    one, two = encoder.draw(["é", "\n"], [1, 2], 5)
    assert len(one) == len(segmentations(encoder, "é")) and len(two) == len(segmentations(encoder, "\n"))
    assert {tuple(x[0].tolist()) for x in one} == set(segmentations(encoder, "é")) and one[0][3] == 0.0
    alone = encoder.draw(["some text here"], [5], 2)[0]
    among = encoder.draw(["other", "some text here", "x y z"], [3, 5, 4], 2)[1]
    assert [x[0].tolist() for x in alone] == [x[0].tolist() for x in among] and [x[2] for x in alone] == [x[2] for x in among]


def test_tables(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (3, "", "x"), (None, "words", "x"), (4, "long " * 60_000, "x"), (5, "x" * 5000, "x")]
    got = p.sample_encodings(spark.createDataFrame(rows, "doc_id long, text string, sample string")).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(by[1]) == 4 and len({tuple(r["pieces"]) for r in by[1]}) == 2
    assert len(by[2]) == 1 and by[2][0]["pieces"] is None and by[3][0]["pieces"] == [] and len(by[None]) == len(by[4]) == len(by[5]) == 2
    assert all(r["decodes"] for r in got if r["doc_id"] != 2)
    assert p.sample_encodings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_decoding(spark):
    v = p.Vocabulary.load(p.MODEL)
    control = next(i for i, x in enumerate(v.pieces) if x is None)
    texts = ["a b", "", None, " two  spaces\n", "é€😀 ▁ mark", "long " * 20_000]
    drawn = p.sample_encodings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), k=3).withColumnRenamed("sample", "text")
    back = p.decode(drawn)  # replaces the column of that name
    assert back.count() == drawn.count() and {(r["doc_id"], r["text"]) for r in back.collect()} == set(enumerate(texts))
    odd = [([control, v.first_byte + 0x20, v.first_byte + 0x61, None, -1, 10**9],), ([v.first_byte + 0x20, v.first_byte + 0xFF],), ([],), (None,), (None,)]
    assert sorted(map(repr, (r[1] for r in p.decode(spark.createDataFrame(odd, "pieces array<int>")).collect()))) == sorted(map(repr, ["a", "\ufffd", "", None, None]))
    assert p.decode(spark.createDataFrame([], "pieces array<int>")).count() == 0


def test_vocabulary_comes_from_the_session(spark, tmp_path):
    spark.conf.set(p.MODEL_SETTING, str(tmp_path / "none.model"))
    try:
        with pytest.raises((OSError, RuntimeError)):
            p.sample_encodings(spark.createDataFrame([], "doc_id long, text string"))
    finally:
        spark.conf.unset(p.MODEL_SETTING)


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline as c

    boiler, base = "the site menu line", " ".join(f"kalo{i} mitu re" for i in range(40))
    rows = [(i, f"{boiler}\n" + " ".join(f"lore{i}x{k} tuka" for k in range(30)), "aa", "s", 1) for i in range(40)]
    rows += [(100, base, "aa", "t", 1), (101, base + " end", "aa", "t", 1), (102, None, None, None, None), (103, "", "aa", "s", 0), (104, "12 34", "aa", "s", 5), (105, boiler, "aa", "s", 18), (None, base, "aa", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    at = dict(c.STAGES)
    kept = at["language_id"](spark, docs, "").cache()
    assert {r["doc_id"] for r in kept.collect()} == {*range(40), 100, 101, 105, None} and kept.columns == docs.columns
    cut = at["line_dedup"](spark, kept, "").cache()
    assert cut.columns == docs.columns and cut.filter(cut.text.contains(boiler)).count() == 0 and cut.filter("doc_id = 105").count() == 0
    assert cut.filter("doc_id < 40 and n_chars <> length(text)").count() == 0
    one = at["near_duplicates"](spark, cut, "").cache()
    assert {r["doc_id"] for r in one.collect()} == {*range(40), 100, None}
    mixed = at["source_mix"](spark, one, "").cache()
    assert mixed.columns == docs.columns and mixed.count() > 0 and set(mixed.distinct().collect()) <= set(one.collect())
    last = at["piece_sampling"](spark, mixed, "")
    assert last.filter("not decodes").count() == 0 and last.filter("sample = 1").count() == mixed.count()
    for _, stage in c.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0


def test_pipeline_keeps_one_of_copies_that_fill_a_source(spark):
    import corpus_pipeline as c

    own = lambda i: "\n".join(" ".join(f"w{i}x{j}y{k}" for k in range(8)) for j in range(5))
    menu = "the site menu line"
    rows = [(i, f"{menu}\n{own(i)}", "s") for i in range(20)]
    rows += [(100 + i, f"{menu}\n{own(100)}", "s") for i in range(10)]  # copies: a third
    rows += [(200 + i, f"{own(i + 200)}", "t") for i in range(20)]
    rows += [(300 + i, f"{own(300)}\nlast {i}", "t") for i in range(10)]  # near copies: a third
    rows += [(400 + i, own(400), "u") for i in range(3)]  # a source of nothing but copies
    docs = spark.createDataFrame([(i, t, "aa", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    at = dict(c.STAGES)
    cut = at["line_dedup"](spark, docs, "").cache()
    assert cut.count() == len(rows) and cut.filter(cut.text.contains(menu)).count() == 0 and cut.filter("doc_id >= 100 and length(text) < 200").count() == 0
    got = sorted(r["doc_id"] for r in at["near_duplicates"](spark, cut, "").collect())
    assert got == [*range(20), 100, *range(200, 220), 300, 400]


def test_one_row_of_each_component_stays(spark):
    from siltmill.llm import jaccard_forest as j

    a, b, c = (" ".join(f"{x}{k} word" for k in range(30)) for x in "abc")
    rows = [(1, a), (1, a), (1, a), (2, b), (3, b), (3, c), (4, c), (5, ""), (5, ""), (6, None), (None, a), (None, a)]
    got = j.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "text"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [(1, a), (2, b), (3, c), (5, ""), (5, ""), (6, None), (None, a), (None, a)]))


def test_pipeline_against_brute_force(spark):
    """Every stage over the whole smallest table, each against a plain version of its work on what the one before kept."""
    import corpus_pipeline as c
    import duckdb

    from siltmill.llm import jaccard_forest, language_id, line_ratio, queries
    from siltmill.llm.tables import table, written

    sf_dir = "/root/testdata/sf0.001"
    docs = table(spark, sf_dir, "documents")
    at, rows = dict(c.STAGES), lambda df: sorted(map(tuple, df.collect()), key=repr)

    kept = written(at["language_id"](spark, docs, sf_dir), "kept")
    told = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert rows(kept) == rows(docs.filter(docs.doc_id.isin([k for k, r in told.items() if r["lang_pred"] != "und" and r["score"] >= language_id.LEAST_SCORE])))

    def shingles(text):
        w = text.encode().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    def components(texts):
        """The smallest index that each text reaches by pairs alike at 0.8."""
        sets, root = [shingles(t) for t in texts], list(range(len(texts)))
        for a in range(len(texts)):
            for b in range(a):
                if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                    low, high = sorted((root[a], root[b]))
                    root = [low if x == high else x for x in root]
        return root

    cut = written(at["line_dedup"](spark, kept, sf_dir), "cut")
    lines = lambda t: {x.strip(" \t\n\x0b\x0c\r") for x in t.split("\n")} - {""}
    want = []
    for source in {r["source"] for r in kept.collect()}:
        mine = [r for r in kept.collect() if r["source"] == source]
        texts = sorted({r["text"] for r in mine})
        over = lambda pages, n: {x for x, k in Counter(x for p in pages for x in p).items() if k >= line_ratio.LEAST_PAGES and k > line_ratio.RATIO * n}
        often = over([lines(t) for t in texts], len(texts)) if source is not None else set()
        held = [t for t in texts if lines(t) & often]
        groups = components(held)
        pages = [set().union(*(lines(t) & often for t, g in zip(held, groups) if g == k)) for k in set(groups)]
        drop = over(pages, len(texts) - len(held) + len(pages))
        for r in mine:
            left = [x for x in r["text"].split("\n") if x.strip(" \t\n\x0b\x0c\r") not in drop]
            same = len(left) == r["text"].count("\n") + 1
            text = "\n".join(left)
            if same or text.strip(" "):
                want.append((r["doc_id"], text, r["lang"], r["source"], r["n_chars"] if same else len(text)))
    assert rows(cut) == sorted(want, key=repr)

    one = written(at["near_duplicates"](spark, cut, sf_dir), "one")
    before = sorted(cut.collect(), key=lambda r: r["doc_id"])
    assert rows(one) == sorted((tuple(r) for i, (r, g) in enumerate(zip(before, components([r["text"] for r in before]))) if g == i or not r["text"].split()), key=repr)
    assert jaccard_forest.WIDTH == 5

    mixed = written(at["source_mix"](spark, one, sf_dir), "mixed")
    con = duckdb.connect()
    con.register("documents", one.toPandas())
    copies = {k: n for k, n in con.execute(f"SELECT doc_id, copies FROM ({queries.ORACLE['op8_source_mix']})").fetchall() if n}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(copies) and set(mixed.collect()) <= set(one.collect())

    last = at["piece_sampling"](spark, mixed, sf_dir)
    back = Counter(map(tuple, p.decode(last.filter("sample = 1")).select("doc_id", "text").collect()))
    assert back == Counter((r["doc_id"], r["text"]) for r in mixed.collect()) and last.filter("NOT decodes").count() == 0


def test_batches_are_decoded_in_parts_of_bounded_size(monkeypatch):
    seen, whole = [], p.decoded_texts
    monkeypatch.setattr(p, "decoded_texts", lambda pieces, spelling: seen.append(len(pieces)) or whole(pieces, spelling))
    spelling = pa.array([b" a", b"b", None], pa.binary())
    lists = [None if i % 7 == 3 else [0] + [1] * (i % 5) + [2] for i in range(1203)]
    got = p.decoded_in_parts(pa.array(lists, pa.list_(pa.int32())), spelling).to_pylist()
    assert got == [None if x is None else "a" + "b" * (len(x) - 2) for x in lists]
    assert sum(seen) == 1203 and max(seen) <= 500
    assert p.decoded_in_parts(pa.array([], pa.list_(pa.int32())), spelling).to_pylist() == []
