import itertools
import random

import numpy as np

from courtside.llm import queries as Q
from courtside.llm import toxicity as X
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose


def slow_kernel(a, b):
    """Sum over equal letter triples of the product of weights, by definition."""
    def features(w):
        s = "^" + "".join(c for c in w if c.isalpha()) + "$"
        out = {}
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if k - i < X.SPAN:
                out[s[i] + s[j] + s[k]] = out.get(s[i] + s[j] + s[k], 0) + X.DECAY ** (k - i + 1)
        return out
    x, y = features(a), features(b)
    dot = sum(v * y.get(u, 0) for u, v in x.items())
    return dot / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


def test_kernel_is_by_definition():
    marks = ["idiot", "clown", "banana", "aaaa", "trash"]
    words = ["idiot", "idi-ot", "i.d.i.o.t", "clown", "clowns", "banana", "ananas", "thing", "aaa", "trrash"]
    w, m, v = X.Kernel([x.encode() for x in marks]).near([x.encode() for x in words], floor=0.05)
    got = {(words[a], marks[b]): x for a, b, x in zip(w.tolist(), m.tolist(), v.tolist())}
    for a, b in itertools.product(words, marks):
        want = slow_kernel(a, b)
        assert abs(got.get((a, b), 0) - want) < 1e-5 or want < 0.05
    assert got["i.d.i.o.t", "idiot"] > 0.999 < got["idi-ot", "idiot"] and got["trrash", "trash"] > X.FLOOR


def test_spelt_out_words():
    assert X.forms(b"you i d i o t ! a cat") == [b"you", b"idiot!a", b"cat"]
    assert X.forms(None) == [] and X.forms(b"a b cat") == [b"a", b"b", b"cat"]


def test_edges_and_inserted_characters(spark):
    insults = ["idiot", "moron", "clown", "stupid"]
    rows = edge_rows()
    for i in range(60):
        w = prose(40, i).split()
        w[5] = insults[i // 2 % 4] if i % 2 else w[5]
        rows.append(doc(100 + i, " ".join(w)))
    for i, x in enumerate(["idi*ot", "m.o.r.o.n", "clo_wn", "s t u p i d"]):
        w = prose(40, 300 + i).split()
        rows.append(doc(300 + i, " ".join([*w[:9], x, *w[9:]])))
    rows += [doc(400 + i, prose(40, 400 + i)) for i in range(10)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(60)] + [(None, 1), (7, None), (101, 1)], "doc_id long, toxic int")
    model = X.train(docs, labels, "doc_id", "text", "toxic")
    got = X.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}

    assert all(score[300 + i] >= 0.5 for i in range(4))
    assert sum(score[400 + i] >= 0.5 for i in range(10)) <= 1
    assert max(score[k] for k in (1, 2, 3, 9)) < 0.5
    assert {r["score"] for r in X.score(docs, X.train(docs, labels.limit(0), "doc_id", "text", "toxic")).collect()} == {0.0}
    assert X.score(docs.limit(0), model).count() == 0


INSULTS = "trash pathetic worthless idiot disgusting loser scum clown moron stupid".split()


def inserted(r, word, n):
    for _ in range(n):
        at = r.randint(1, len(word) - 1)
        word = word[:at] + r.choice("abcdefghijklmnopqrstuvwxyz") + word[at:]
    return word


def test_insults_with_inserted_letters_count():
    r, kernel = random.Random(4), X.Kernel([w.encode() for w in INSULTS])
    found = {}
    for n in (1, 2):
        words = [inserted(r, w, n).encode() for w in INSULTS for _ in range(40)]
        found[n] = len(set(kernel.near(words)[0].tolist())) / len(words)
    assert found[1] >= 0.95 and found[2] >= 0.6
    words = [b"idiot", b"idxiot", b"stxxupid", b"stxupxid"]
    assert set(kernel.near(words)[0].tolist()) == set(range(len(words)))


def test_texts_with_two_inserted_letters_score_above_clean_ones(spark):
    r, rows = random.Random(6), []
    for i in range(160):
        w = prose(40, 7000 + i).split()
        w[9] = INSULTS[i // 2 % len(INSULTS)] if i % 2 else w[9]
        rows.append(doc(i, " ".join(w)))
    for i in range(40):
        w = prose(40, 8000 + i).split()
        rows += [doc(1000 + i, " ".join([*w[:7], inserted(r, INSULTS[i % len(INSULTS)], 2), *w[7:]])), doc(2000 + i, " ".join(w))]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(160)], "doc_id long, toxic int")
    score = {x["doc_id"]: x["score"] for x in X.score(docs, X.train(docs, labels, "doc_id", "text", "toxic")).collect()}
    above = np.mean([(score[1000 + i] > score[2000 + j]) + (score[1000 + i] == score[2000 + j]) / 2 for i in range(40) for j in range(40)])
    assert above >= 0.8


def test_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = Q.QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1").filter("held_out").join(labels, "doc_id").collect()
    up = [r for r in held if r["toxic"]]
    assert sum(r["predicted"] for r in up) >= 0.75 * len(up)
    assert sum(r["predicted"] for r in held if not r["toxic"]) <= 0.02 * len(held)


def test_rows_of_texts_by_definition():
    """A text's row: the largest kernel value of its words with each landmark, zero below the floor, raised."""
    marks = ["idiot", "clown", "trash", "the", "reading"]
    texts = ["you idxiot and cl-own, reading the tra#sh", "a b c", "", None, "idiot idiot i d i o t", "theory reads clowns",
             *(prose(30, i) for i in range(12)), "x" * 300 + " tr.a.s.h", "ÉTÉ über ñandú"]
    got = X.Rows([m.encode() for m in marks]).of([None if t is None else t.encode() for t in texts])
    for t, row in zip(texts, got):
        words = {w.decode() for w in X.forms(None if t is None else t.encode())}
        for m, value in zip(marks, row):
            best = max((slow_kernel(w, m) for w in words if any(c.isalpha() for c in w)), default=0)
            want = best**X.POWER if best >= X.FLOOR else 0
            assert abs(value - want) < 1e-5 or abs(best - X.FLOOR) < 1e-6
