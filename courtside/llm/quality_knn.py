"""Quality score by nearest labelled neighbours in a latent semantic space.

A text is the hashed byte trigrams of all its bytes (so letters, case, symbols and spacing count) and,
as one more feature, its words that repeat the word before, TF-IDF weighted. The latent space is a randomised SVD of all texts: document frequencies and then the tasks'
shares of ``X'(X W)`` are added up on Spark (features x sketch, whatever the corpus size). The
labelled texts' vectors are broadcast; every document's cosine with each of them is computed exactly,
a block of documents at a time, and its ``NEIGHBOURS`` nearest vote with their similarity as weight.

``MAX_LABELLED`` bounds the labelled rows (those first by a hash of their id, a fixed sample);
everything else covers all documents.

Defined cases: null and empty texts, and any text without a labelled neighbour of positive similarity,
score the share of label 1 among the labelled (0.5 without labels). Ids labelled twice count once
with the mean, rounded up; rows with a null label or id aren't learned from. Equal similarities
go to the neighbour first by id. Texts are used whole; repeated rows get equal scores.
"""

from __future__ import annotations

from itertools import islice
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import per_batch, sum_arrays

GRAMS = 4096
FEATURES = GRAMS + 1
#: Weight of the repeated words against the trigrams.
REPEATS = 3.0
RANK, SKETCH = 64, 96
MAX_LABELLED = 8192
NEIGHBOURS = 24
POWER = 8
SEED = 11
BLOCK = 256


def trigram_counts(texts: list) -> np.ndarray:
    """Counts of hashed byte trigrams and, last, of words that repeat the word before; a row a text."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for i, t in enumerate(texts):
        if t and len(t) > 2:
            for at in range(0, len(t) - 2, 1 << 20):
                b = np.frombuffer(t, np.uint8, min((1 << 20) + 2, len(t) - at), at).astype(np.uint32)
                code = (b[:-2] * np.uint32(65536) + b[1:-1] * np.uint32(256) + b[2:]) * np.uint32(2654435761) >> np.uint32(20)
                out[i, :GRAMS] += np.bincount(code, minlength=GRAMS)
        elif t:
            out[i, len(t)] = 1
        if t:
            words = t.split()
            out[i, GRAMS] = sum(map(eq, words, islice(words, 1, None)))
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    x[:, GRAMS] *= REPEATS
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def latent_space(texts: DataFrame) -> dict:
    """``idf`` and the leading ``RANK`` directions of one column of texts."""

    def blocks(texts: list):
        return (trigram_counts(texts[at : at + BLOCK]) for at in range(0, len(texts), BLOCK))

    def frequencies():
        return lambda texts: sum((np.append((x > 0).sum(axis=0), len(x)) for x in blocks(texts)), np.zeros(FEATURES + 1))

    df = sum_arrays(texts, frequencies, FEATURES + 1)
    idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32) + np.float32(0.1)
    random = np.random.default_rng(SEED).standard_normal((FEATURES, SKETCH)).astype(np.float32)
    shared = texts.sparkSession.sparkContext.broadcast((idf, random))

    def ranges():
        idf, random = shared.value

        def add(texts: list) -> np.ndarray:
            out = np.zeros((FEATURES, SKETCH))
            for x in blocks(texts):
                x = weighted(x, idf)
                out += x.T @ (x @ random)
            return out.ravel()

        return add

    b = sum_arrays(texts, ranges, FEATURES * SKETCH).reshape(FEATURES, SKETCH) / max(df[-1], 1.0)
    core = random.T.astype(float) @ b
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-9 * max(values.max(initial=0), 1e-12)
    u, s, _ = np.linalg.svd(b @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return {"idf": idf, "basis": np.ascontiguousarray(u[:, :RANK], np.float32)}


def embed(texts: list, space: dict) -> np.ndarray:
    """Unit vectors in the latent space (zero for empty texts)."""
    x = weighted(trigram_counts(texts), space["idf"]) @ space["basis"]
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, all_texts: DataFrame) -> dict:
    """Latent space of ``all_texts`` and the vectors of at most ``MAX_LABELLED`` labelled rows of ``docs``."""
    space = latent_space(all_texts)
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).filter("id is not null and y is not null")
             .groupBy("id").agg(F.floor(F.avg("y") + 0.5).alias("y")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("id is not null and text is not null")
    ids = texts.select("id").distinct()
    sample = known.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(MAX_LABELLED)
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def make():
        return lambda texts: [np.concatenate([embed(texts[at : at + BLOCK], shared.value) for at in range(0, len(texts), BLOCK)]).tolist()]

    vectors = per_batch(texts.join(F.broadcast(sample), "id"), "text", [("v", T.ArrayType(T.FloatType()))], make)  # at most MAX_LABELLED ids
    rows = sorted(vectors.groupBy("id").agg(F.first("y").alias("y"), F.min("v").alias("v")).collect(), key=lambda r: r["id"])
    return {**space, "vectors": np.array([r["v"] for r in rows], np.float32).reshape(len(rows), space["basis"].shape[1]), "labels": np.array([r["y"] for r in rows], float)}


def vote(x: np.ndarray, model: dict) -> np.ndarray:
    """Scores of unit vectors: labels of the nearest neighbours, weighted by a power of the cosine."""
    labels, n = model["labels"], len(model["labels"])
    prior = labels.mean() if n else 0.5
    if not n:
        return np.full(len(x), prior)
    near = x @ model["vectors"].T
    k = min(NEIGHBOURS, n)
    if k < n:
        # ties at the cut go to the first by id
        cutoff = -np.partition(-near, k - 1, axis=1)[:, k - 1 : k]
        above = near > cutoff
        room = k - above.sum(axis=1, keepdims=True)
        level = near == cutoff
        use = above | (level & (np.cumsum(level, axis=1) <= room))
    else:
        use = np.ones_like(near, bool)
    w = np.where(use, np.maximum(near, 0).astype(float) ** POWER, 0.0)
    total = w.sum(axis=1)
    return np.where(total > 1e-12, (w @ labels) / np.maximum(total, 1e-12), prior).clip(0, 1)


def score(docs: DataFrame, model: dict, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        return lambda texts: [np.concatenate([vote(embed(texts[at : at + BLOCK], model), model) for at in range(0, len(texts), BLOCK)])]

    return per_batch(docs, text_col, [(out, T.DoubleType())], make)
