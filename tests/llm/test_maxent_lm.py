import math
import os
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from siltmill.llm import maxent_lm as lm
from siltmill.llm import queries

SF = "/root/testdata/sf0.001"


def by_hand(rows):
    """held_out, n_tokens, n_known, N, base score of (id, text) rows in order."""
    split = lambda x: [*(x or "").encode().lower().split(), b"\n"]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    c = Counter(t for h, (_, x) in zip(held, rows) if not h for t in split(x))
    n, v = sum(c.values()), len(c)
    for h, (_, x) in zip(held, rows):
        tokens = split(x)
        yield h, len(tokens), sum(c[t] > 0 for t in tokens), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)


ROWS = [(i, " ".join(f"w{j * j % (i + 3)}" for j in range(i % 17))) for i in range(60)]
ROWS += [(None, None), (7, "Again AGAIN éÉ"), (7, "Again AGAIN éÉ"), (8, ""), (9, "w1 " * 30_000), (None, "w2\tw2\nnew")]


@pytest.mark.parametrize("broadcast", [0, 5, 1000])
def test_counts_and_base_scores_match(spark, broadcast):
    docs = spark.createDataFrame([(i, x, "x", k) for k, (i, x) in enumerate(ROWS)], "doc_id long, text string, uid string, n_tokens int")
    got = lm.score_texts(docs, broadcast=broadcast).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:5], round(r[5], 6))
    want = sorted(key((i, *x)) for (i, _), x in zip(ROWS, by_hand(ROWS)))
    assert sorted(key(r) for r in got) == [pytest.approx(x) for x in want]
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    docs = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")
    got = lm.score_texts(docs).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(3, 0, 0)] * 3
    assert all(abs(r.base_score) < 1e-9 and r.score <= 0 for r in got)
    assert lm.score_texts(docs.limit(0)).count() == 0


def a_model(spark, texts):
    docs = spark.createDataFrame([(i, x.encode()) for i, x in enumerate(texts)], "uid long, text binary")
    words = lm.vocabulary(lm.token_counts(docs))
    return lm.fit(lm.encoded(docs, words).select("uid", "codes"), words), words


def test_probabilities_of_all_codes_add_up_to_one(spark):
    model, words = a_model(spark, ["the cat sat on the mat", "the dog sat", "le chat est la", "le chien est la"] * 20)
    every = np.arange(lm.CODES)
    for before in ([], [1], [2, 3], [lm.HEAD + 5, 1], [4, 4, 4]):
        codes = np.concatenate([[*before, k] for k in every])
        lengths = np.full(lm.CODES, len(before) + 1)
        last = model.code_logs(codes, lengths)[np.cumsum(lengths) - 1]
        assert np.exp(last).sum() == pytest.approx(1, abs=1e-3)
    # tokens of an ending: the known ones and one unseen token
    tail = np.full(lm.ENDINGS, 0.1)
    for t, i in words.known.places.items():
        if words.known.codes[i] >= lm.HEAD:
            tail[words.known.codes[i] - lm.HEAD] += words.known.counts[i] + 0.1
    assert words.masses == pytest.approx(tail)


def test_gradients_are_summed_by_feature():
    rng = np.random.default_rng(0)
    found, slope = rng.integers(0, 40, (5, 300)), rng.normal(size=(300, 4)).astype(np.float32)
    found[:, :200] = 3  # one very common feature
    rows, times, sums = lm._by_feature(slope, found)
    want = np.zeros((lm.DIMENSIONS + 1, 4))
    np.add.at(want, found.ravel(), np.tile(slope, (5, 1)))
    want[-1] = slope.sum(axis=0)
    assert sums == pytest.approx(want[rows], abs=1e-3) and not np.delete(want, rows, axis=0).any()
    assert times.tolist() == [*np.bincount(found.ravel())[rows[:-1]], 300]


def test_scaling_meets_what_was_observed():
    rng = np.random.default_rng(1)
    words, one, two = (rng.integers(0, k, 5000) for k in (6, 4, 3))
    words = np.where(one == 1, words % 2, words)
    table = lambda part, a, b: pd.DataFrame({"first": a, "second": b}).value_counts().reset_index(name="n").assign(part=part)
    cells = pd.concat([table(0, one, two), table(1, words, one), table(2, words, two)]).assign(**{"class": 0})
    codes, first, second, norm = lm.scaled(cells)
    p = np.exp(first[one] + second[two] - norm[one, two][:, None])
    assert p.sum(axis=1) == pytest.approx(1)
    for c in range(4):
        assert p[one == c].sum(axis=0) == pytest.approx(np.bincount(words[one == c], minlength=6), rel=0.1, abs=8)


def test_features_do_not_see_across_texts():
    codes, lengths = np.array([5, 6, 7, 8, 5, 6, 7]), np.array([3, 1, 3])
    found = lm.features(codes, lengths)
    assert (found[:, :3] == found[:, 4:]).all() and (found[:, 3] == found[:, 0]).all()
    assert found.min() >= 0 and found.max() < lm.DIMENSIONS


def test_texts_are_grouped_whole():
    codes = [np.arange(n, dtype=np.int16) for n in (3, 50, 1, 2)]
    batch = pa.RecordBatch.from_arrays([pa.array([c.tobytes() for c in codes])], ["codes"])
    got = [(x.tolist(), n.tolist()) for x, n in lm._grouped(iter([batch]), 10)]
    assert [n for _, n in got] == [[3, 50], [1, 2]]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_model_beats_single_tokens_on_held_out_texts(spark):
    got = queries.op13_lm_scoring(spark, SF).toPandas()
    assert len(got) == 200
    out = got[got["held_out"]]
    assert out["score"].sum() > out["base_score"].sum() + 0.1 * out["n_tokens"].sum()
