import base64
import collections
import math
import re

import tiktoken

from courtside.llm import quality_rules as R
from tests.llm.frames import DOC_SCHEMA, doc, edge_rows, prose


def words(t):
    return re.findall(r"[^\x20\x09-\x0d]+", t or "")


def brute(t):
    w, cover, seen, dup = words(t), set(), set(), 0
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts = collections.Counter(grams)
    for i, g in enumerate(grams):
        if counts[g] > 1:
            cover.update(range(i, i + 5))
    for line in (t or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w))


def test_counts_and_tokens(spark):
    texts = [prose(40, 1), "a b c d e f " * 9, "x\nx\n \n x\nx", "### $$$ ok & | <b>", prose(12, 2) + "\n" + prose(12, 2), "ééé ñ 世界 " * 5]
    rows = edge_rows() + [doc(50 + i, t) for i, t in enumerate(texts)]
    got = R.judge(spark.createDataFrame(rows, DOC_SCHEMA), prefix="q_").collect()
    assert len(got) == len(rows)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, R.read_vocabulary().splitlines())}
    enc = tiktoken.Encoding("t", pat_str=R.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in got:
        assert tuple(r["q_" + c] for c in [*R.COUNTS, "base_failed"]) == brute(r["text"])
        w = words(r["text"])
        tokens = [t for x in w for t in enc.encode_ordinary(" " + x)]
        if not w:
            assert r["q_chars_per_token"] is None and not r["q_kept"]
            continue
        counts = collections.Counter(tokens)
        assert abs(r["q_chars_per_token"] - sum(map(len, w)) / len(tokens)) < 1e-9
        assert abs(r["q_token_entropy"] + sum(n / len(tokens) * math.log2(n / len(tokens)) for n in counts.values())) < 1e-6


def test_repeated_words_beyond_one_word_code():
    import numpy as np

    ids = np.concatenate([np.arange(20_000), np.arange(7)])  # too many forms for one code
    assert R.repeated_words(ids) == 14


def test_clean_stays_and_junk_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = R.judge(docs).join(labels, "doc_id").filter("not base_failed")
    assert got.filter("quality = 1 and not kept").count() == 0
    assert got.filter("quality = 0 and not kept").count() > got.filter("quality = 0").count() * 0.4


def test_stage(spark):
    docs = spark.createDataFrame(edge_rows() + [doc(70, "a b c d e f " * 20)], DOC_SCHEMA)
    kept = R.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {5, 6, 7} <= ids and not ids & {1, 2, 3, 4, 70}
    assert R.keep_good(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
