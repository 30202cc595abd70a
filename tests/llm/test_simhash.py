import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from courtside.llm import simhash as S
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose


def brute_fingerprint(t, k=4):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64(x.encode(), 42).intdigest() for x in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(codes, bits=4):
    low = list(range(len(codes)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in itertools.combinations(range(len(codes)), 2):
        if bin(codes[a] ^ codes[b]).count("1") <= bits:
            x, y = find(a), find(b)
            low[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(codes))]


def clustered(n, seed):
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(max(1, n // 12))]
    out = set()
    while len(out) < n:
        x = r.choice(base)
        for _ in range(r.randint(0, 5)):
            x ^= 1 << r.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("text", [None, "", "one", "A b C", "A b C d", "Ä b c d e f é Z", prose(300, 3)])
def test_fingerprint(text):
    assert S.fingerprint(text.encode() if text is not None else None) == brute_fingerprint(text)


@pytest.mark.parametrize("seed", range(4))
def test_trie_walk_is_brute_force(seed, monkeypatch):
    monkeypatch.setattr(S, "FRONT", 50)  # many small pieces
    groups = [clustered(60, seed * 10 + g) for g in range(3)]
    group = np.concatenate([[g] * len(c) for g, c in enumerate(groups)])
    codes = np.array([c for g in groups for c in g], np.uint64)
    got = S.trie_links(group, codes)
    want, at = [], 0
    for c in groups:
        want += [x + at for x in brute_components(c)]
        at += len(c)
    assert got.tolist() == want


@pytest.mark.parametrize("split", [5, 2048])
def test_links_and_components(spark, split):
    codes = clustered(150, 5)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    edges = S.links(spark.createDataFrame([(x,) for x in signed], "fp long"), split=split)
    reach = {r["a"]: r["b"] for r in S.connected(edges).collect()}
    sets = {}
    for i, x in enumerate(brute_components(codes)):
        sets.setdefault(x, set()).add(signed[i])
    assert {frozenset(s) for s in sets.values() if len(s) > 1} == {
        frozenset(k for k in signed if reach.get(k, k) == root) for root in set(reach.values())}


def test_documents_with_edges(spark):
    rows = edge_rows() + [doc(100 + i, prose(80, i % 7) + (" x" if i % 2 else "")) for i in range(28)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = S.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    codes = [brute_fingerprint(r[1]) for r in rows]
    low = {}
    for r, c in zip(rows, brute_components(codes)):
        if r[0] is not None:
            low[c] = min(low.get(c, r[0]), r[0])
    want = sorted(((r[0] is None, r[0] or 0, x, low.get(c) is None, low.get(c) or 0) for r, x, c in zip(rows, codes, brute_components(codes))))
    assert want == sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fp"] % 2**64, r["component"] is None, r["component"] or 0) for r in got)
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(brute_components(codes)))  # one of each group, of repeated rows too


def test_empty(spark):
    docs = spark.createDataFrame([], DOC_SCHEMA)
    assert S.near_duplicates(docs).count() == 0 and S.drop_near_duplicates(docs).count() == 0
