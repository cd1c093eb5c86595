"""The language query against the same model learned the plain way: sums over dictionaries, one weight at a time."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from siltmill.llm import language_id as g
from siltmill.llm import queries

SF = "/root/testdata/sf0.001"


def features(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not words:
        return {}
    points, found = [ord(c) for c in f" {' '.join(words)} "], Counter()
    for start in range(len(points)):
        h = 0
        for n in range(1, 4):
            if start + n <= len(points):
                h = (h * 0x01000193 + points[start + n - 1] * 0x9E3779B1 + n) % 2**32
                found[((h ^ (h >> 15)) * 0x85EBCA6B % 2**32) >> 17] += 1
    return dict(found)


def shares(logits):
    top = max(logits)
    e = [math.exp(z - top) for z in logits]
    return [x / sum(e) for x in e]


def learn(rows, k, rate=0.5, beta=1.0, l1=0.02, l2=0.1):
    z, n = {}, {}

    def weight(f, j):
        soft, hard = (0, 0) if f == "bias" else (l1, l2)
        pull = z.get((f, j), 0.0)
        return 0.0 if abs(pull) <= soft else -(abs(pull) - soft) * math.copysign(1, pull) / ((beta + math.sqrt(n.get((f, j), 0.0))) / rate + hard)

    for turn in range(4):
        for i in np.random.default_rng(turn).permutation(len(rows)):
            x, label = rows[i]
            w = {(f, j): weight(f, j) for f in x for j in range(k)}
            p = shares([sum(v * w[f, j] for f, v in x.items()) for j in range(k)])
            for f, v in x.items():
                for j in range(k):
                    slope = v * (p[j] - (j == label))
                    before = n.get((f, j), 0.0)
                    n[f, j] = before + slope * slope
                    z[f, j] = z.get((f, j), 0.0) + slope - (math.sqrt(n[f, j]) - math.sqrt(before)) / rate * w[f, j]
    return lambda x: [sum(v * weight(f, j) for f, v in x.items()) for j in range(k)]


def test_query_equals_the_model_learned_plainly(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet'").fetchall()
    away = {d for d, *_ in docs if zlib.crc32(str(d).encode()) % 5 == 0}
    found = {d: features(t) for d, t, _ in docs}
    known = [(d, lang) for d, t, lang in docs if d not in away and t is not None and lang is not None]
    assert len(known) < g.MOST_ROWS / 4  # so that the sample is all of them
    df = Counter(f for d, _ in known for f in found[d])

    def unit(d):
        x = {f: (1 + math.log(c)) * (math.log((1 + len(known)) / (1 + df.get(f, 0))) + 1) for f, c in found[d].items()}
        size = math.sqrt(sum(v * v for v in x.values()))
        return {**{f: v / size for f, v in x.items()}, "bias": 1.0}

    names = sorted({lang for _, lang in known})
    mark = lambda d: xxhash.xxh64_intdigest(str(d).encode(), 42) % 2**30
    sample = [(unit(d), names.index(lang)) for d, lang in sorted(known, key=lambda r: (r[1], mark(r[0]))) if found[d]]
    logits = learn([s for i, s in enumerate(sample) if i % 5 != 4], len(names))
    left = [(logits(x), label) for i, (x, label) in enumerate(sample) if i % 5 == 4]
    doubt = 1 / (len(left) + 2)

    def loss(t):
        return -sum(((1 - doubt) * (j == label) + doubt / len(names)) * math.log(p) for z, label in left for j, p in enumerate(shares([x / t for x in z])))

    low, high = math.log(0.02), math.log(20)
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(math.exp(a)) < loss(math.exp(b)) else (a, high)
    t = math.exp(low)
    got = {r.doc_id: r for r in queries.op7_language_id(spark, SF).collect()}
    assert len(got) == len(docs) and {d for d, r in got.items() if r.held_out} == away
    for d, *_ in docs:
        if not found[d]:
            assert (got[d].lang_pred, got[d].score) == ("und", 0)
            continue
        p = shares([z / t for z in logits(unit(d))])
        assert got[d].lang_pred == names[p.index(max(p))]
        assert got[d].score == pytest.approx(max(p), abs=1e-3)
