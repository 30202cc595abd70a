import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from courtside.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, WHITENED string, n string"


def brute(rows):
    """Components up to 16 over the distinct whole vectors, by a dense solver."""
    kept = [(k, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for k, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted(set(map(tuple, (x for _, x in kept)))), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return kept, n, sums, e, v


def compare(got, rows, kept_components):
    kept, n, sums, e, v = brute(rows)
    assert len(got) == len(kept) * kept_components
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    for key, x in kept:
        x = np.array(x)
        for k in range(kept_components):
            for r in by[key][k + 1]:
                assert r["n"] == n and r["deviation"] == int(((n * x - sums) ** 2).sum())
                assert abs(r["explained"] - e[k] / e.sum()) <= 1e-9 * r["explained"] and r["identity_error"] < 1e-9
                want = (x - sums / n) @ v[:, k] / np.sqrt(e[k])
                assert abs(abs(r["whitened"]) - abs(want)) < 1e-6
    # one sign for all rows of a component
    for k in range(kept_components):
        signs = {np.sign(by[key][k + 1][0]["whitened"] * ((np.array(x) - sums / n) @ v[:, k])) for key, x in kept if abs(by[key][k + 1][0]["whitened"]) > 1e-3}
        assert len(signs) == 1


def test_edges_against_a_dense_solver(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(c) for c in r.normal(size=20) * np.arange(1, 21)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(1000, 1400)]  # many copies
    odd = [(2000, None), (2001, []), (2002, [None] + [1.0] * 19), (2003, [float("nan")] + [1.0] * 19), (2004, [float("inf")] + [0.0] * 19), (2005, [1.0] * 3)]
    nulls = [(None, rows[3][1])]
    frame = spark.createDataFrame([(k, v, None, "x", "y") for k, v in rows + odd + nulls], SCHEMA).repartition(30)
    got = W.whiten(frame).collect()
    compare([x for x in got if x["vec_id"] is not None], rows, 16)
    assert sum(x["vec_id"] is None for x in got) == 16 and not {2000, 2001, 2002, 2003, 2004, 2005} & {x["vec_id"] for x in got}


def test_few_components_and_none(spark):
    flat = [(i, [float(i), 2.0 * i, 1.0]) for i in range(10)]
    got = W.whiten(spark.createDataFrame([(k, v, None, None, None) for k, v in flat], SCHEMA)).collect()
    compare(got, flat, 1)
    same = spark.createDataFrame([(i, [1.0, 2.0], None, None, None) for i in range(5)], SCHEMA)
    assert W.whiten(same).collect() == [] and W.whiten(same.limit(0)).collect() == []
    assert W.whiten(same).schema == W.whiten(same.limit(0)).schema
    wide = spark.createDataFrame([(1, [1e30, 0.0], None, None, None), (2, [-1e30, 5.0], None, None, None), (3, [0.0, 1.0], None, None, None)], SCHEMA)
    assert all(r["deviation"] is None or r["deviation"] >= 0 for r in W.whiten(wide).collect())


@pytest.mark.parametrize("name", ["random", "equal values", "low rank", "scales", "repeats", "whole steps"])
def test_updates_and_merges(name):
    r = np.random.default_rng(5)
    y = {"random": r.integers(-99, 99, (200, 12)), "equal values": np.concatenate([np.eye(6), -np.eye(6)] * 4).astype(int),
         "low rank": r.integers(-3, 4, (60, 2)) @ r.integers(-3, 4, (2, 9)), "scales": r.integers(-5, 6, (150, 5)) * np.array([1, 10, 10**4, 1, 10**6]),
         "repeats": np.repeat(r.integers(-5, 6, (4, 7)), 9, axis=0), "whole steps": np.arange(40)[:, None] * np.array([[1, 1, 0]])}[name] + 1_000_000
    parts = [W.Spectrum(y.shape[1]) for _ in range(3)]
    for p, x in zip(parts, np.array_split(y, 3)):
        p.add(x)
    for p in parts[1:]:
        parts[0].merge(p)
    s = parts[0]
    c = y - y.mean(axis=0)
    v = c.T @ c
    assert s.n == len(y) and list(s.sums) == list(y.sum(axis=0))
    assert np.abs(s.u @ np.diag(s.d) @ s.u.T - v).max() <= 1e-12 * np.abs(v).max()
    assert np.abs(s.u.T @ s.u - np.eye(s.u.shape[1])).max() < 1e-12


def test_secular_roots_interlace():
    r = np.random.default_rng(7)
    for k in (1, 2, 9, 40):
        d = np.sort(r.random(k)) * 10 ** r.integers(0, 6)
        z2 = r.random(k) ** 4 + 1e-9
        origin, t = W.secular_roots(d, z2, 0.7)
        roots = np.append(d, d[-1] + 0.7 * z2.sum())[origin] + t
        assert (roots >= d).all() and (roots[:-1] <= d[1:]).all()
        assert np.allclose(roots, np.linalg.eigvalsh(np.diag(d) + 0.7 * np.outer(np.sqrt(z2), np.sqrt(z2))), rtol=1e-11, atol=1e-12 * d[-1])


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = E.queries()["op11_whitening"](spark, sf)
    compare(got.collect(), rows, 16)
    assert got.select(F.max("identity_error")).first()[0] < 1e-9
