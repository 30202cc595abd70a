import itertools

import numpy as np

from courtside.llm import langid as L
from courtside.llm import queries as Q
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose

FR = ("eau", "oi", "ment", "é", "è", "que", "tion", "ou")


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    scores = -rng.random((20, 3)) * 8
    lens = np.array([4, 0, 6, 1])
    ids = rng.integers(0, 20, lens.sum())
    got = L.viterbi(scores, ids, lens, switch=2.0)
    at = 0
    for n in lens:
        own = ids[at : at + n]
        best = max((sum(scores[w, s] for w, s in zip(own, path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:])) for path in itertools.product(range(3), repeat=int(n))), default=0)
        mine = got[at : at + n].tolist()
        value = sum(scores[w, s] for w, s in zip(own, mine)) - 2.0 * sum(a != b for a, b in zip(mine, mine[1:]))
        assert abs(value - best) < 1e-9
        at += n


def test_scripts_and_spans(spark):
    docs = spark.createDataFrame([doc(i, prose(80, i), "en") for i in range(6)] + [doc(i, prose(80, i, FR), "fr") for i in range(6)]
                                 + [doc(i, "добро пожаловать в этот большой мир где живут люди", "ru") for i in range(3)], DOC_SCHEMA)
    model = L.train(docs)
    assert model["langs"] == ["en", "fr", "ru"]
    mixed = prose(40, 50) + " " + prose(40, 51, FR)
    rows = spark.createDataFrame([doc(1, mixed), doc(2, "неизвестное слово"), doc(3, "世界 和平")], DOC_SCHEMA)
    got = {r["doc_id"]: r for r in L.predict(rows, model, spans="spans").collect()}
    assert [s["lang"] for s in got[1]["spans"]] == ["en", "fr"]
    assert sum(s["words"] for s in got[1]["spans"]) == 80 and abs(got[1]["spans"][1]["first"] - 40) <= 3
    assert got[2]["lang_pred"] == "ru" and got[2]["score"] == 1.0
    assert got[3]["lang_pred"] in model["langs"]  # a script nobody writes rules no language out


def test_edges(spark):
    docs = spark.createDataFrame(edge_rows(), DOC_SCHEMA)
    model = L.train(docs.filter("lang is not null"))
    got = L.predict(docs, model, score="lang_score").collect()
    assert len(got) == docs.count()
    for r in got:
        blank = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == blank and 0 <= r["lang_score"] <= 1
    kept = L.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["lang_pred"] != "und" for r in got)
    none = spark.createDataFrame([], DOC_SCHEMA)
    assert L.predict(docs.drop("score"), L.train(none)).filter("lang_pred <> 'und'").count() == 0
    assert L.keep_known(none).count() == 0


def test_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = Q.QUERIES["op4_langid"](spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    assert got.count() == docs.count()
    held = got.filter("held_out")
    assert held.filter("lang = lang_pred").count() >= 0.97 * held.count()


def test_pieces_of_words_bound_memory_and_change_nothing():
    import random
    import tracemalloc

    import numpy as np

    from courtside.llm import langid as L
    r = random.Random(4)
    words = list({"".join(r.choice("abcdefghijklmnopqrstuvwxyzäéñ") for _ in range(r.randint(1, 12))).encode() for _ in range(420_000)})[:300_000]
    model = {"table": np.random.default_rng(1).random((L.BUCKETS, 4)).astype(np.float32), "allowed": np.ones((len(L._NAMES), 4), bool), "langs": list("abcd")}
    some = words[:20_000]
    whole, n = L._some_scores(some, model)
    cut, m = L.word_scores(some, model)
    assert np.array_equal(whole, cut) and np.array_equal(n, m)
    assert [x for lo, hi in L.pieces(words, 1000) for x in range(lo, hi)] == list(range(len(words)))
    tracemalloc.start()
    L.word_scores(words, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(words) == 300_000 and peak < 80_000_000
