import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
from courtside.llm import packing as K
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose


def check_packing(rows, texts, capacity, most_docs=None, most_cost=None):
    """Round trip against the tokenizer; sequences gapless and under every capacity."""
    tokenizer = Tokenizer.from_str(K.read_vocabulary())
    want = []
    for key, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, s in enumerate(range(0, len(ids), capacity)):
            x = ids[s : s + capacity]
            want.append((key, k, s, len(x), zlib.crc32(x.tobytes())))
    assert sorted(map(repr, (tuple(r)[:5] for r in rows))) == sorted(map(repr, want))
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in bins.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
        if len(found) > 1:
            assert len(found) <= (most_docs or capacity) and sum(n * n for _, n in found) <= (most_cost or capacity**2)
    return bins


def test_edges_and_constraints(spark):
    odd = [doc(50, "a<|endoftext|> <|startoftext|>b it's été ÀÉ ΑΣ"), doc(51, "\x1c\x85 x y"), doc(52, "z" * 40_000 + " " + "q " * 9000)]
    rows = edge_rows() + odd + [doc(i, prose(i % 90, i)) for i in range(100, 400)] + [doc(i, "same words here") for i in range(500, 700)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    texts = [(r[0], r[1]) for r in rows]
    for capacity, most_docs, most_cost, rule in ((2048, None, None, "norm"), (256, 5, 20_000, "norm"), (256, 9, 30_000, "dot")):
        got = K.pack(docs, K.read_vocabulary(), capacity=capacity, most_docs=most_docs, most_cost=most_cost, rule=rule).collect()
        bins = check_packing(got, texts, capacity, most_docs, most_cost)
        if most_docs is None:
            assert len(bins) <= -(-sum(r["length"] for r in got) // capacity) + 1


def test_words_across_slabs_and_forgetting(monkeypatch):
    """Equal ids whether words are remembered, forgotten or new, in any order of texts."""
    texts = [prose(400, i) + (" W\u00f6rter, e\u0301, a.b, x.,; y?! z.\t'tis. it's, 5. (so:) <|endoftext|>, \u0130stanbul e\u0301t\u00e9, x'll 12a <|ENDOFTEXT|> <|endoftext|>" if i % 3 else "") for i in range(40)] + [None, "", " \n ", "z" * 5000]
    tokenizer = Tokenizer.from_str(K.read_vocabulary())
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    column = pa.array(texts)
    for kept, slab in ((600_000, 8_000_000), (50, 3000), (0, 1)):
        monkeypatch.setattr(K, "KEPT_WORDS", kept)
        tokens = K.WordTokens(K.read_vocabulary())
        got = [x.tolist() for lo, hi in K.slabs_of(column, slab) for x in tokens.ids(column.slice(lo, hi - lo))]
        assert got == want
    assert list(K.slabs_of(pa.array([], pa.string()))) == []


def slow_plan(counts, capacity, most_docs, most_cost, weights):
    """Best fit of one piece after another, without groups of equal sequences."""
    rooms = []
    full = np.array([capacity, most_docs, most_cost])
    for n in sorted(counts, reverse=True):
        need = np.array([n, 1, n * n])
        left = counts[n]
        tried = sorted((i for i, r in enumerate(rooms) if (r >= need).all()), key=lambda i: (sum(w * ((a - b) / c) ** 2 for w, a, b, c in zip(weights, rooms[i], need, full)), i))
        for i in tried:
            while left and (rooms[i] >= need).all():
                rooms[i] = rooms[i] - need
                left -= 1
        while left:
            rooms.append(full - need)
            left -= 1
            while left and (rooms[-1] >= need).all():
                rooms[-1] = rooms[-1] - need
                left -= 1
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit(seed):
    r = np.random.default_rng(seed)
    capacity, most_docs = 64, int(r.integers(3, 64))
    most_cost = int(r.integers(900, 4096))
    counts = {int(n): int(c) for n, c in zip(r.integers(1, 30, 20), r.integers(1, 40, 20))}
    runs = K.plan(counts, capacity, most_docs, most_cost)
    assert (runs[:, 3] + runs[:, 2]).max() == slow_plan(counts, capacity, most_docs, most_cost, K.WEIGHTS)
    assert {int(n): int(runs[runs[:, 0] == n, 2].sum()) for n in counts} == counts
    used, seen = {}, set()
    for n, rank, bins, at, offset in runs.tolist():
        for k in range(bins):
            assert (n, rank + k) not in seen
            seen.add((n, rank + k))
            used.setdefault(at + k, []).append((offset, n))
    for found in used.values():
        assert [o for o, _ in sorted(found)] == list(np.cumsum([0] + [n for _, n in sorted(found)])[:-1])
        assert sum(n for _, n in found) <= capacity and len(found) <= most_docs and sum(n * n for _, n in found) <= most_cost


def test_plan_follows_lengths_not_pieces():
    few = {n: 3 for n in range(1, 2049)}
    many = {n: 3_000_000 for n in range(1, 2049)}
    a, b = K.plan(few), K.plan(many)
    assert len(b) < 60_000 and (b[:, 3] + b[:, 2]).max() >= 1_000_000 * (a[:, 3] + a[:, 2]).max() * 0.99
    tokens = sum(n * c for n, c in many.items())
    assert (b[:, 3] + b[:, 2]).max() <= 1.001 * tokens / 2048


def test_query_and_empty(spark):
    got = E.queries()["op13_packing"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    bins = check_packing(got, [tuple(r) for r in docs], 2048)
    assert len(bins) <= -(-sum(r["length"] for r in got) // 2048) + 1
    assert K.pack(spark.createDataFrame([], DOC_SCHEMA), K.read_vocabulary()).collect() == []
