import hashlib
import zlib

import duckdb
import pytest

from courtside.llm import merkle as M
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf(r, lower=False):
    text = r["text"]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    fields = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([digest(*x[i : i + 16]) for i in range(0, len(x), 16)])
    return levels


def slow(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = climb([leaf(r) for r in by[s]])
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for p, s in enumerate(order):
        for i, r in enumerate(by[s]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            node, proof = leaf(r, hit), []
            for levels, at in ((trees[s], i), (top, p)):
                for level in levels[:-1]:
                    run, own = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    proof += run[:own] + run[own + 1 :]
                    node = digest(*run[:own], node, *run[own + 1 :])
                    at //= 16
            out.append((r["doc_id"], leaf(r), trees[s][-1][0], top[-1][0], digest(*proof), node, node == top[-1][0]))
    return out


def frames():
    some = edge_rows() + [doc(i, f"Text {prose(3, i)}", "en", "big") for i in range(100, 400)]
    some += [doc(i, f"TEXT {i}", None, f"s{i}") for i in range(400, 420)] + [doc(3, "Twice", "en", "big")] * 2 + [doc(None, "No Id", "en", "big")] * 2
    yield "many sources", some
    yield "one source", [doc(i, f"Row {i}", "en", "a") for i in range(17)]
    yield "one row", [doc(5, "Alone", "en", "a")]
    yield "null source", [doc(i, f"Row {i}", "en", None) for i in range(256)]
    yield "runs of one", [doc(i, f"Row {i}", "en", s) for s in ("a", "", None, "b") for i in range(257)]


@pytest.mark.parametrize("name, rows", list(frames()), ids=[n for n, _ in frames()])
def test_against_brute_force_and_sql(spark, name, rows):
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(5)
    got = [tuple(r) for r in M.verify(M.prove(M.build(docs))).select(*COLUMNS).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, slow([r.asDict() for r in docs.collect()])))
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert sorted(map(repr, con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({M.oracle(3)})").fetchall())) == sorted(map(repr, got))


def test_hot_source_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(M, "PART_ROWS", 50)
    rows = [doc(i * 7 % 1009, f"T{i}", "en", "hot" if i % 3 else f"s{i % 40}") for i in range(1000)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    manifest = M.build(docs)
    assert manifest.row_height == 3 and manifest.leaves.where("source = 'hot'").select("of").first()[0] == 666
    got = [tuple(r) for r in M.verify(M.prove(manifest)).select(*COLUMNS).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, slow([r.asDict() for r in docs.collect()])))


def test_records_are_content_addressed(spark):
    rows = [doc(1, "Same", "en", "a")] * 64
    manifest = M.build(spark.createDataFrame(rows, DOC_SCHEMA))
    assert manifest.records("rows", 1).count() == 1  # four equal runs, stored once for the descent
    got = M.verify(M.prove(manifest)).collect()
    assert len(got) == 64 and len({r["root"] for r in got}) == 1


def test_empty(spark):
    assert M.verify(M.prove(M.build(spark.createDataFrame([], DOC_SCHEMA)))).collect() == []
