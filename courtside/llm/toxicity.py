"""Toxicity by a gapped subsequence string kernel, Nyström landmarks and a linear support vector machine.

The kernel of two words adds, over all letter triples in order (with marks for the word's begin and
end), the product of their weights ``DECAY ** span``; a triple may skip letters up to a span of ``SPAN``.
It is normalised and raised to a power. Characters that aren't letters are skipped at no cost. So an insult
with inserted or left out characters stays close to the insult, and one spelt out letter by letter is read
as a word. Landmarks are words that mark labelled toxic texts (chi-square over a sample of labelled
texts) and frequent other words. A sentence's row of kernel values is the largest over its words, and
a text's the largest over its sentences, as one insulting sentence makes a text toxic; values
under ``FLOOR`` count as zero, so that long texts don't add up chance likeness. The Nyström map of
these rows goes to a squared-hinge SVM, whose margin a logistic fit turns into a probability.

``MAX_LABELLED`` bounds the labelled rows (those first by a hash of their id).

Defined cases: null, empty and letterless texts have a row of zeros and score like any clean text.
Ids labelled twice count once with the mean, rounded up; rows with a null label or id aren't learned
from; without labels of both kinds the score is the share of label 1 (0 without any). Landmark
ties go to the word first by code point. Texts are used whole; repeated rows get equal scores.
"""

from __future__ import annotations

from itertools import groupby, islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import WHITE_RE, Numbers, per_batch, slabs

DECAY, SPAN = 0.7, 6
#: The kernel is raised to this power (a product of kernels): near matches stand out from chance likeness.
POWER = 2
MARKS, OTHERS = 224, 32
#: Chosen by four folds inside the training rows, on texts as they are and with one to three letters
#: inserted into their insults (README).
FLOOR = 0.4
MAX_LABELLED = 8192
COST, RIDGE = 1.0, 0.1
ALPHABET = 128
_BEGIN, _END = 126, 127
#: Letters of words worked on at once, and word forms remembered in a task.
CHUNK, FORMS = 30_000, 400_000


def letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(code of every letter, its word), the letters of each word set between the marks. Letters
    beyond a-z share 100 codes."""
    joined = "\n".join(w.decode("utf-8", "replace") for w in words)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    word = np.cumsum(points == 10)
    kinds = np.full(len(points), -1, np.int64)
    plain = (points >= 97) & (points <= 122)
    kinds[plain] = points[plain] - 97
    far = np.flatnonzero(points >= 128)
    if len(far):
        unique, at = np.unique(points[far], return_inverse=True)
        alpha = np.array([chr(u).isalpha() for u in unique])
        kinds[far] = np.where(alpha[at], 26 + points[far] % 100, -1)
    real = kinds >= 0
    size = np.bincount(word[real], minlength=len(words))
    size += 2 * (size > 0)
    start = np.cumsum(size) - size
    codes = np.empty(int(size.sum()), np.int64)
    inner = np.ones(len(codes), bool)
    has = size > 0
    inner[start[has]] = inner[(start + size - 1)[has]] = False
    codes[inner] = kinds[real]
    codes[start[has]], codes[(start + size - 1)[has]] = _BEGIN, _END
    return codes, np.repeat(np.arange(len(words)), size)


def triples(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, triple code, weight) of every gapped letter triple of every word."""
    codes, owner = letters(words)
    out: list[list[np.ndarray]] = [[], [], []]
    for j in range(1, SPAN - 1):
        for k in range(j + 1, SPAN):
            n = len(codes) - k
            if n <= 0:
                continue
            a, b, c = codes[:n], codes[j : j + n], codes[k : k + n]
            ok = owner[:n] == owner[k : k + n]
            out[0].append(owner[:n][ok])
            out[1].append((a[ok] * ALPHABET + b[ok]) * ALPHABET + c[ok])
            out[2].append(np.full(int(ok.sum()), DECAY ** (k + 1)))
    if not out[0]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in out)


def summed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, triple code, weight) with one row for each of a word's distinct triples."""
    w, code, weight = triples(words)
    key, inverse = np.unique(w * ALPHABET**3 + code, return_inverse=True)
    return key // ALPHABET**3, key % ALPHABET**3, np.bincount(inverse, weights=weight, minlength=len(key))


class Kernel:
    """Normalised kernel values of words with the landmarks, as a sparse product over shared triples."""

    def __init__(self, landmarks: list[bytes]) -> None:
        self.landmarks = landmarks
        w, code, weight = summed(landmarks)
        length = np.sqrt(np.bincount(w, weights=weight**2, minlength=len(landmarks)))
        order = np.argsort(code, kind="stable")
        codes, self.size = np.unique(code, return_counts=True)
        self.start = np.cumsum(self.size) - self.size
        self.mark, self.value = w[order], (weight / np.maximum(length[w], 1e-12))[order]
        self.row = np.full(ALPHABET**3, -1, np.int32)  # of a triple: its place in start and size
        self.row[codes] = np.arange(len(codes))

    def gram(self) -> np.ndarray:
        """Kernel values of the landmarks with each other."""
        table = np.zeros((len(self.start), len(self.landmarks)))
        table[np.repeat(np.arange(len(self.start)), self.size), self.mark] = self.value
        return table.T @ table

    def near(self, words: list[bytes], floor: float = FLOOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, landmark, value) of all values of at least ``floor``."""
        codes, owner = letters(words)
        codes = codes.astype(np.int32)
        marks = len(self.landmarks)
        count = np.bincount(owner, minlength=len(words))
        least = np.zeros(len(words))  # squared length if no triple repeats, else below it
        rows, owners, weights = [], [], []
        for k in range(2, SPAN):
            n = len(codes) - k
            if n <= 0:
                break
            weight = DECAY ** (k + 1)
            least += (k - 1) * np.maximum(count - k, 0) * weight**2
            inside = np.flatnonzero(owner[:n] == owner[k:])
            ends, own = codes[inside] * (ALPHABET * ALPHABET) + codes[inside + k], owner[inside]
            for j in range(1, k):
                row = self.row[ends + codes[inside + j] * ALPHABET]
                hit = np.flatnonzero(row >= 0)
                rows.append(row[hit])
                owners.append(own[hit])
                weights.append(np.full(len(hit), weight))
        if not rows or not marks:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        row = np.concatenate(rows)
        size = self.size[row]
        upto = np.cumsum(size)
        at = np.repeat(self.start[row] - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)
        key = np.repeat(np.concatenate(owners) * marks, size) + self.mark[at]
        dot = np.bincount(key, weights=self.value[at] * np.repeat(np.concatenate(weights), size), minlength=len(words) * marks).reshape(len(words), marks)
        bar = floor * np.sqrt(least)
        some = np.flatnonzero((dot.max(axis=1) >= bar * (1 - 1e-9)) & (least > 0))
        if not len(some):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        w, _, weight = summed([words[i] for i in some])
        length = np.sqrt(np.bincount(w, weights=weight**2, minlength=len(some)))
        value = dot[some] / length[:, None]
        a, b = np.nonzero(value >= floor)
        return some[a], b, np.minimum(value[a, b], 1.0)


def forms(text: bytes | None) -> list[bytes]:
    """Lower-case words; runs of three or more one-letter words are one word."""
    words = (text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode()).split() if text else []
    sizes = list(map(len, words))
    if sizes.count(1) > 2:
        out: list[bytes] = []
        at = 0
        for one, run in groupby(n == 1 for n in sizes):
            n = sum(1 for _ in run)
            out.extend([b"".join(words[at : at + n])] if one and n > 2 else words[at : at + n])
            at += n
        return out
    return words


class Rows:
    """Rows of largest kernel values for lists of texts; remembers what it has found for word forms."""

    def __init__(self, landmarks: list[bytes]) -> None:
        self.kernel = Kernel(landmarks)
        self.clear()

    def clear(self) -> None:
        self.seen, self.done = Numbers(), 0
        self.found: list[tuple] = []

    def of(self, texts: list) -> np.ndarray:
        if len(self.seen) > FORMS:
            self.clear()
        number = self.seen.__getitem__
        ids = [np.unique(np.fromiter(map(number, x), np.int64, len(x))) for x in map(forms, texts)]
        new = list(islice(self.seen, self.done, None))
        size = np.cumsum([len(w) + 2 for w in new]) if new else np.zeros(0)
        at = 0
        while at < len(new):
            upto = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + CHUNK)))
            w, mark, value = self.kernel.near(new[at:upto])
            self.found.append((w + self.done + at, mark, value))
            at = upto
        self.done += len(new)
        out = np.zeros((len(texts), len(self.kernel.landmarks)), np.float32)
        if not self.found:
            return out
        word, mark, value = self.found[0] if len(self.found) == 1 else tuple(np.concatenate(x) for x in zip(*self.found))
        self.found = [(word, mark, value)]
        start = np.searchsorted(word, np.arange(self.done + 1))
        # every (text, word) pair's kernel values, the largest kept by text and landmark
        pairs = np.concatenate(ids)
        size = start[pairs + 1] - start[pairs]
        text = np.repeat(np.repeat(np.arange(len(ids)), [len(x) for x in ids]), size)
        at = np.repeat(start[pairs] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        np.maximum.at(out.reshape(-1), text * out.shape[1] + mark[at], value[at].astype(np.float32))
        return out**POWER


def _matrix(docs: DataFrame, landmarks: list[bytes], text_col: str, out: str, finish) -> DataFrame:
    """``docs`` with what ``finish`` makes of the texts' rows."""

    def make():
        rows = Rows(landmarks)
        return lambda texts: [np.concatenate([rows.of(texts[lo:hi]) for lo, hi in slabs(texts)])]

    kind = T.ArrayType(T.FloatType()) if finish is None else T.DoubleType()

    def outer():
        work = make()
        return lambda texts: [work(texts)[0].tolist() if finish is None else finish(work(texts)[0])]

    return per_batch(docs, text_col, [(out, kind)], outer)


def pick_landmarks(sample: DataFrame) -> list[bytes]:
    """Words that mark texts with y = 1 and frequent other words, from (y, text) of a bounded sample."""
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return []
    words = F.array_distinct(F.transform(F.split(F.lower("text"), WHITE_RE), lambda w: F.regexp_replace(w, r"^\P{L}+|\P{L}+$", "")))
    counts = (sample.select("y", F.explode(words).alias("word")).filter(r"word rlike '^\\p{L}{3,24}$'")
              .groupBy("word").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")))
    expected = (F.col("a") + F.col("b")) * F.lit(n1 / (n1 + n0))
    marks = counts.filter((F.col("a") >= 2) & (F.col("a") > expected)).orderBy(((F.col("a") - expected) ** 2 / expected).desc(), "word").limit(MARKS)
    others = counts.orderBy(F.col("b").desc(), "word").limit(OTHERS)
    return [w.encode() for w in dict.fromkeys([r["word"] for r in marks.collect()] + [r["word"] for r in others.collect()])]


def _svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last one the offset) of a squared-hinge SVM by Newton steps; y is -1 or 1."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) / COST
    ridge[-1, -1] = 1e-6
    for _ in range(50):
        active = y * (x @ w) < 1
        if not active.any():
            break
        a = x[active]
        new = np.linalg.solve(ridge + a.T @ a, a.T @ y[active])
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y = 1) from the margin (targets moved in from 0 and 1 a little)."""
    up, down = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    z, beta = np.column_stack([margin, np.ones(len(margin))]), np.zeros(2)
    cost = np.where(y == 1, np.sqrt(max(1.0, down / max(up, 1))), 1.0)  # the rarer kind counts more
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (cost * p * (1 - p))[:, None]) + 1e-6 * np.eye(2), z.T @ (cost * (t - p)) - 1e-6 * beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> dict:
    """Landmarks, SVM and logistic fit from at most ``MAX_LABELLED`` labelled rows of ``docs``."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).filter("id is not null and y is not null")
             .groupBy("id").agg(F.floor(F.avg("y") + 0.5).cast("int").alias("y")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("id is not null and text is not null")
    sample = known.join(texts.select("id").distinct(), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(MAX_LABELLED)
    rows = texts.join(F.broadcast(sample), "id")  # at most MAX_LABELLED ids
    rows = rows.groupBy("id").agg(F.first("y").alias("y"), F.min("text").alias("text"))
    landmarks = pick_landmarks(rows)
    if not landmarks:
        n = rows.agg(F.avg("y")).first()[0]
        return {"landmarks": [], "share": float(n or 0.0)}
    got = sorted(_matrix(rows.select("id", "y", "text"), landmarks, "text", "v", None).select("id", "y", "v").collect(), key=lambda r: r["id"])
    x, y = np.array([r["v"] for r in got], float), np.array([r["y"] for r in got], float)
    values, vectors = np.linalg.eigh(Kernel(landmarks).gram() ** POWER + RIDGE * np.eye(len(landmarks)))
    nystroem = (vectors / np.sqrt(np.maximum(values, 1e-9))) @ vectors.T
    w = _svm(x @ nystroem, 2 * y - 1)
    slope, offset = _logistic(x @ nystroem @ w[:-1] + w[-1], y)
    return {"landmarks": landmarks, "weights": nystroem @ w[:-1], "offset": float(w[-1]), "slope": slope, "shift": offset}


def score(docs: DataFrame, model: dict, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability that each text is toxic."""
    if not model["landmarks"]:
        return docs.withColumn(out, F.lit(model["share"]))

    def finish(rows: np.ndarray) -> np.ndarray:
        margin = rows.astype(float) @ model["weights"] + model["offset"]
        return 1 / (1 + np.exp(-np.clip(model["slope"] * margin + model["shift"], -30, 30)))

    return _matrix(docs, model["landmarks"], text_col, out, finish)
