import collections
import math
import re
import zlib

import numpy as np
import pytest

from courtside.llm import brown_lm as B
from courtside.llm import queries as Q
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose


def words(t):
    return re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())


@pytest.mark.parametrize("head", [3, 100_000])
def test_base_is_by_definition(spark, head, monkeypatch):
    monkeypatch.setattr(B.head_words, "__defaults__", (head,))  # counts by broadcast and by join agree
    rows = edge_rows() + [doc(100 + i, prose(50, i)) for i in range(30)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    model, counts = B.train(docs.filter("doc_id < 120"))
    got = B.score(docs.select("doc_id", "text"), model, counts).collect()
    c = collections.Counter(w for r in rows if r[0] is not None and r[0] < 120 for w in [*words(r[1]), None])
    n, v = sum(c.values()), len(c)
    want = []
    for r in rows:
        w = [*words(r[1]), None]
        want.append((r[0] or -1, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)))
    for a, b in zip(sorted(want), sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got)):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6 * abs(a[4])
    assert all(r["score"] < 0 for r in got)


def test_classes_and_transitions_are_distributions(spark):
    docs = spark.createDataFrame([doc(i, prose(80, i)) for i in range(40)] + [doc(i, prose(80, i, ("eau", "oi", "ment", "tion"))) for i in range(40)], DOC_SCHEMA)
    model, counts = B.train(docs)
    assert np.allclose((10 ** model["move"]).sum(axis=1), 1)
    got = B.score(docs.select("doc_id", "text"), model, counts).collect()
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def likelihood(pairs, classes, k):
    table = np.zeros((k, k))
    for (a, b), n in pairs.items():
        table[classes[a], classes[b]] += n
    part = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    return part(table) - part(table.sum(axis=0)) - part(table.sum(axis=1))


def test_exchange_takes_the_best_class():
    rng = np.random.default_rng(4)
    n, k = 12, 4
    for _ in range(20):
        pairs = {(a, b): int(rng.integers(1, 50)) for a in range(n) for b in range(n) if a != b and rng.random() < 0.5}
        classes, w = rng.integers(0, k - 1, n), int(rng.integers(0, n))
        after, before = np.zeros((n, k)), np.zeros((n, k))
        for (a, b), x in pairs.items():
            after[a, classes[b]] += x
            before[b, classes[a]] += x
        got, _ = B.exchange(after, before, classes, np.array([w]), k - 1)
        best = max(likelihood(pairs, [h if i == w else c for i, c in enumerate(classes)], k) for h in range(k - 1))
        assert abs(likelihood(pairs, got, k) - best) < 1e-6


def test_empty_training(spark):
    docs = spark.createDataFrame(edge_rows(), DOC_SCHEMA)
    model, counts = B.train(docs.limit(0))
    got = B.score(docs.select("doc_id", "text"), model, counts).collect()
    assert len(got) == docs.count() and all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in got)
    assert B.score(docs.limit(0).select("doc_id", "text"), *B.train(docs)).count() == 0


def test_held_out(spark):
    got = Q.QUERIES["op7_brown_lm"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 1000 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    n = sum(r["n_tokens"] for r in held)
    assert (sum(r["score"] for r in held) - sum(r["base_score"] for r in held)) / n > 0.2  # under two thirds of the perplexity


@pytest.mark.parametrize("head", [5, 100_000])
def test_model_score_is_by_definition(spark, head, monkeypatch):
    """Class transitions and word emissions counted again from the texts, given the classes alone."""
    monkeypatch.setattr(B.head_words, "__defaults__", (head,))
    train = [prose(40 + i, i) for i in range(25)] + [None, ""]
    tests = [prose(30, 90), "unseen wörds ΑΒΓ", "", None, prose(60, 3)]
    docs = spark.createDataFrame([doc(i, t) for i, t in enumerate(train)], DOC_SCHEMA)
    model, counts = B.train(docs)
    c = collections.Counter(w for t in train for w in words(t))
    ranked = sorted(c.items(), key=lambda x: (-x[1], x[0]))
    bars = sorted(c.values(), reverse=True)
    ranked = [x for x in ranked if sum(n >= x[1] for n in bars) <= head]  # ties at the edge stay out
    symbols = {w: i for i, (w, _) in enumerate(ranked[: B.SYMBOLS])}
    kind = lambda w: int(model["classes"][symbols.get(w, B.ending(w))])
    k, mark = B.CLASSES, B.CLASSES - 1
    table = np.zeros((k, k))
    for t in train:
        path = [mark, *map(kind, words(t)), mark]
        for a, b in zip(path, path[1:]):
            table[a, b] += 1
    share = (table.sum(axis=0) + 0.5) / (table.sum(axis=0) + 0.5).sum()
    move = np.log10((table + B.SMOOTH * share) / (table.sum(axis=1, keepdims=True) + B.SMOOTH))
    mass, types = np.zeros(k), np.zeros(k)
    for w, n in c.items():
        mass[kind(w)] += n
        types[kind(w)] += 1
    rows = spark.createDataFrame([doc(i, t) for i, t in enumerate(tests)], DOC_SCHEMA)
    got = {r["doc_id"]: r["score"] for r in B.score(rows.select("doc_id", "text"), model, counts).collect()}
    for i, t in enumerate(tests):
        path = [mark, *map(kind, words(t)), mark]
        want = sum(move[a, b] for a, b in zip(path, path[1:]))
        want += sum(math.log10((c[w] + 0.5) / (mass[kind(w)] + 0.5 * (types[kind(w)] + 1))) for w in words(t))
        assert abs(got[i] - want) < 1e-6 * max(1, abs(want))


def test_clashing_names(spark):
    docs = spark.createDataFrame([doc(i, prose(20, i)) for i in range(6)], DOC_SCHEMA)
    odd = docs.selectExpr("doc_id", "text", "1 AS Score", "2 AS n_tokens", "3 AS lm_tokens", "4 AS own_0", "5 AS lm_row", "6 AS more", "7 AS lm_text")
    got = B.score(odd, *B.train(docs))
    assert got.columns == ["doc_id", "lm_tokens", "own_0", "lm_row", "more", "lm_text", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert [r["n_tokens"] for r in got.collect()] == [21] * 6 and got.select("lm_row").distinct().collect()[0][0] == 5
