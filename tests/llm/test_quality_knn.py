import numpy as np

from courtside.llm import quality_knn as K
from courtside.llm import queries as Q
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose


def test_votes_are_brute_force():
    rng = np.random.default_rng(2)
    v = rng.standard_normal((200, 8)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[50:60] = v[40]  # ties
    y = rng.integers(0, 2, 200).astype(float)
    x = np.vstack([v[:30] + 0.1, v[40:42], np.zeros((1, 8), np.float32)]).astype(np.float32)
    got = K.vote(x, {"labels": y, "vectors": v})
    for row, score in zip(x, got):
        near = row @ v.T
        best = sorted(range(200), key=lambda i: (-near[i], i))[: K.NEIGHBOURS]
        w = np.maximum(near[best], 0).astype(float) ** K.POWER
        assert abs(score - ((w @ y[best]) / w.sum() if w.sum() > 1e-12 else y.mean())) < 1e-4


def test_edges(spark):
    rows = edge_rows() + [doc(100 + i, prose(60, i)) for i in range(20)] + [doc(200 + i, "buy now!!! $$$ " * (10 + i)) for i in range(20)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    labels = spark.createDataFrame([(100 + i, 1) for i in range(15)] + [(200 + i, 0) for i in range(15)] + [(7, 1), (7, 1), (None, 0), (3, None), (999, 0)], "doc_id long, quality int")
    model = K.train(docs, labels, "doc_id", "text", "quality", docs.select("text"))
    assert len(model["labels"]) == 31
    got = K.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all((r["score"] >= 0.3) == (r["doc_id"] < 200) for r in got if r["doc_id"] and r["doc_id"] >= 100)
    none = K.train(docs, labels.limit(0), "doc_id", "text", "quality", docs.select("text"))
    assert {r["score"] for r in K.score(docs, none).collect()} == {0.5}
    assert K.score(docs.limit(0), K.train(docs.limit(0), labels, "doc_id", "text", "quality", docs.limit(0).select("text"))).count() == 0


def test_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = Q.QUERIES["op6_quality_knn"](spark, "/root/testdata/sf0.01")
    assert got.count() == 1000
    held = got.filter("held_out").join(labels, "doc_id")
    assert held.filter("predicted = quality").count() >= 0.93 * held.count()
