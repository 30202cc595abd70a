import random

import numpy as np

from courtside.llm import decontam as D
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_lcs():
    r = random.Random(1)
    for _ in range(200):
        a = [r.randrange(6) for _ in range(r.randint(0, 90))]
        b = [r.randrange(6) for _ in range(r.randint(0, 90))]
        assert D.lcs(a, b) == slow_lcs(a, b)


def test_planted(spark):
    items = [(i, prose(20 + 3 * i, 1000 + i)) for i in range(12)] + [(90, None), (91, ""), (92, "...")]
    r = random.Random(3)
    rows, want = edge_rows(), set()
    for i, text in items[:12]:
        around = prose(300, 2000 + i).split()
        w = text.split()
        changed = [prose(1, 5000 + k) if r.random() < 0.2 else x for k, x in enumerate(w)]  # a paraphrase
        for n, part in enumerate((w, [x.upper() + "!!" for x in w], changed)):
            cut = r.randrange(len(around))
            rows.append(doc(100 + 10 * i + n, " ".join(around[:cut] + part + around[cut:])))
            want.add((100 + 10 * i + n, i))
    rows += [doc(1000 + i, prose(400, 3000 + i)) for i in range(60)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], h["item_id"]) for r in D.contaminated(docs, bench, out="found").collect() for h in r["found"]}
    assert found == want
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len(want)


def test_empty_sides(spark):
    docs = spark.createDataFrame(edge_rows(), DOC_SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.drop_contaminated(docs, none).count() == docs.count()
    bench = spark.createDataFrame([(1, prose(30, 8))], "item_id long, text string")
    assert D.drop_contaminated(docs.limit(0), bench).count() == 0


def planted(count, docs):
    """(items, documents, wanted pairs): one item a document, as it is or with a sixth of its words changed."""
    items = [(i, prose(30 + i % 60, 50_000 + i)) for i in range(count)]
    r, rows, want = random.Random(11), [], set()
    for k in range(docs):
        i = k * (count // docs)
        w, around = items[i][1].split(), prose(120, 90_000 + k).split()
        if k % 3 == 0:
            w = [prose(1, 200_000 + 100 * k + j) if r.random() < 0.17 else x for j, x in enumerate(w)]
        cut = r.randrange(len(around))
        rows.append(doc(k, " ".join(around[:cut] + w + around[cut:])))
        want.add((k, i))
    return items, rows, want


def test_recall_with_thousands_of_items(spark):
    items, rows, want = planted(2400, 240)
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], h["item_id"]) for r in D.contaminated(docs, bench, out="found").collect() for h in r["found"]}
    assert found == want


def test_driver_holds_sparse_item_rows(spark, monkeypatch):
    items, rows, want = planted(1200, 24)
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    found = D.Items(items)
    model = D.fit(docs.select("text"), found)
    entries = sum(len(x) for x in found.words) * 2  # a word is in at most two passages
    numbers = sum(a.size for v in model.values() for a in (v if isinstance(v, tuple) else (v,)) if isinstance(a, np.ndarray))
    assert numbers <= len(found.vocabulary) * (D.SKETCH + 2) + 4 * entries
    assert not any(isinstance(v, list) for v in model.values())
    monkeypatch.setattr(D, "KEPT", 1)  # spaces fitted anew find the same
    finder = D.Finder(found, model)
    got = [[{(k, h["item_id"]) for h in x} for k, x in enumerate(finder.find([r[1].encode() for r in rows]))] for _ in range(2)]
    assert got[0] == got[1] and set().union(*got[0]) == want and len(finder.kept) == 1
