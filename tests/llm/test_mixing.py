import duckdb

from courtside.llm import mixing as M
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose


def slow_targets(sizes):
    total, order = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    capped = set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        open_w = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else weight[s] * left / open_w for s in order}
        new = {s for s in order if s not in capped and target[s] > 3 * sizes[s]}
        if not new:
            return target
        capped |= new


def test_edges_and_oracle(spark):
    rows = edge_rows() + [doc(i, prose(5 + i % 40, i), "en", f"s{i % 9}" if i % 3 else "big") for i in range(20, 400)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = M.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in got:
        sizes[r["source"]] = r["source_size"]
    want = slow_targets(sizes)
    taken = {}
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"]) and abs(r["target"] - want[r["source"]]) < 1e-6
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in taken.items():
        largest = max(r["size"] for r in got if r["source"] == s)
        assert abs(t - want[s]) <= largest
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert sorted(map(repr, got)) == sorted(map(repr, M.mix(docs).collect()))
    key = lambda r: (r[0] or -1, r[1] or "", r[2], r[3], round(r[4], 6), r[5], r[6])
    table = con.sql(f"SELECT doc_id, source, size, source_size, target, copies, taken FROM ({M.ORACLE})").fetchall()
    assert sorted(map(key, table)) == sorted(key(tuple(r[c] for c in ("doc_id", "source", "size", "source_size", "target", "copies", "taken"))) for r in got)


def test_empty(spark):
    assert M.mix(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
    assert M.mix(spark.createDataFrame([doc(1, None), doc(2, "")], DOC_SCHEMA)).filter("taken <> 0 or target <> 0").count() == 0
