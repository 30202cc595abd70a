import random
import re
import textwrap

import duckdb

from courtside.llm import licences as X
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose


def slow(text):
    """Every run of atoms against every template, by definition: licence -> (-dice, words, first word)."""
    low = re.sub(r"([.!?])[ \t\n\x0b\f\r]+", "\\1\n", (text or "").lower())
    atoms = [a for a in (x.split() for x in re.sub(r"[^a-z0-9\n]+", " ", low).split("\n")) if a]
    ends = [0]
    for a in atoms:
        ends.append(ends[-1] + len(a))
    w = [x for a in atoms for x in a]
    out = {}
    for name, t in X.TEMPLATES:
        g = set(X.template_bigrams(t))
        high = X.size_bounds(len(g))[1]
        if len(g & set(f"{a} {b}" for a, b in zip(w, w[1:]))) == 0:
            continue
        for s in range(len(atoms)):
            for e in range(s, len(atoms)):
                n = ends[e + 1] - ends[s]
                if e > s and n > high + 1:
                    break
                part = w[ends[s] : ends[e + 1]]
                b = {f"{x} {y}" for x, y in zip(part, part[1:])}
                dice = 2 * len(b & g) / (len(b) + len(g))
                if b and dice >= X.THRESHOLD:
                    out[name] = min(out.get(name, (0, 0, 0)), (-dice, n, ends[s]))
    return out


def template(name, k=0):
    return [t for n, t in X.TEMPLATES if n == name][k]


def test_scan(spark):
    mit, gpl, apache, mpl = template("MIT", 3), template("GPL-3.0", 1), template("Apache-2.0", 1), template("MPL-2.0")
    wrapped = "# Copyright (c) 2020 A. Author\n#\n" + "\n".join("# " + x for x in textwrap.wrap(mit, 70)) + "\nimport os\nprint('x')\n"
    texts = [prose(50, 1) + "\n" + gpl, mit.upper(), "Intro here. " + gpl + " " + prose(20, 4), apache[:300].replace(". ", ".\n") + "\n\n" + prose(9, 2),
             "released under the mit licence", "Licensed under the Apache License, Version 2.0", "this is licensed", gpl + "\n" + gpl,
             "released under the mit license " * 3, prose(30, 5) + ". Released under\nthe MIT License. Enjoy it all.", prose(40, 6) + ". " + mpl + " " + prose(40, 7),
             wrapped, "Use of this source code is governed by a BSD-style\nlicense that can be found in the LICENSE file. " + prose(30, 8),
             "\n".join("Released under the MIT License." for _ in range(300)), template("BSD-2-Clause"), template("BSD-3-Clause"), template("LGPL-2.1").replace("library", "program")]
    rows = edge_rows() + [doc(100 + i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    found = X.scan(docs)
    assert "Python" not in (plan := found._jdf.queryExecution().toString()) and "Join" not in plan
    got = {(r["doc_id"], r["licence"]): (-r["dice"], r["words"], r["first_word"]) for r in found.collect()}
    want = {}
    for r in rows:
        for name, x in slow(r[1]).items():
            want[r[0], name] = min(want.get((r[0], name), (0, 0, 0)), x)
    assert got == want
    # repeated on one line, wrapped, of two sentences inside other text, in a comment over code
    assert {(108, "MIT"), (109, "MIT"), (110, "MPL-2.0"), (111, "MIT"), (112, "BSD-3-Clause"), (113, "MIT"), (114, "BSD-2-Clause"), (115, "BSD-3-Clause")} <= set(got)
    assert got[111, "MIT"][0] < -0.95
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert {(a, b): (-c, e, d) for a, b, c, d, e in con.sql(f"SELECT doc_id, licence, dice, first_word, words FROM ({X.oracle()})").fetchall()} == want
    assert X.scan(docs.limit(0)).count() == 0


def test_every_match_has_a_key_word():
    grams = {t: X.template_bigrams(t) for _, t in X.TEMPLATES}
    keys = X.key_words(list(grams.values()))
    r = random.Random(5)
    for text, b in grams.items():
        for _ in range(50):  # the fewest bigrams that can still reach the threshold
            kept = r.sample(b, -(-2 * len(b) // 3))
            there = {w for g in kept for w in g.split()}
            assert any(there.issuperset(k) for k in keys)


def test_size_bounds_lose_nothing():
    for n in range(1, 60):
        low, high = X.size_bounds(n)
        for m in range(1, 200):
            reaches = 2 * min(m, n) / (m + n) >= X.THRESHOLD
            assert reaches <= (low <= m <= high)
            if reaches:  # and the part shares at least the lower bound
                assert -(-X.THRESHOLD * (m + n) // 2) >= low
