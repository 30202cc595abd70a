"""Benchmark decontamination by latent semantic retrieval.

Texts and benchmark items become words (lower case, ASCII punctuation cut off). A document's
passages are windows of ``2 * BLOCK`` words, one every ``BLOCK`` words, over its whole text. Weights are
TF-IDF with document frequencies over all blocks of the corpus; a word that no item has counts in a
passage's length (with the items' mean weight) but has no dimension of its own.

The latent space comes from a randomised SVD: each task adds its blocks' share of ``X'(X W)`` for
a fixed random ``W``; the sum (vocabulary x sketch, whatever the corpus size) gives the corpus' leading
directions by a single-pass range finder. The items' passages stay sparse rows and are taken ``GROUP`` at a
time; each group has a space of its own, fitted in the tasks that search it, over the group's words, of the directions that its rows and the leading ones span. So the rank
follows the items, and none is lost however large the benchmark. Passages are candidates of an item if the cosine
of their projections, counted against the passage's full length, reaches ``COSINE``; passages that can't
reach it (their shared part is too short, or their terms can't add up to it with any item of the group, then of a
family) are dropped before they are projected. A candidate counts if, in a window around it, the longest
common subsequence of words covers ``OVERLAP`` of the item and the item's answer (its last quarter)
is covered to ``ANSWER`` - so paraphrases with changed, added or missing words are found.

The benchmark is a given set, not corpus data: at most ``MAX_ITEMS`` rows (checked), broadcast. The driver holds
its words and vocabulary x sketch numbers, never passages x vocabulary.

Defined cases: null, empty and white texts have no passages and stay clean; items without words
match nothing; equal items each match. Rows are judged alone, so repeated rows and null ids get
equal results. An empty benchmark leaves every document clean, an empty corpus gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import T_to_arrow, families, per_batch, slabs, spare_name, sum_arrays

BLOCK = 24
#: Item passages that share a latent space, and random directions of the corpus sketch.
GROUP, SKETCH = 256, 48
COSINE, OVERLAP, ANSWER = 0.3, 0.6, 0.5
#: Families of like items in a group, used to rule passages out before they are projected.
FAMILIES = 32
#: Spaces that a task keeps in memory.
KEPT = 24
#: Bounds are counted with so much room for rounding.
SLACK = 1e-5
#: A word in over this share of blocks says nothing about a passage.
COMMON = 0.1
MAX_ITEMS = 100_000
SEED = 7

_SPACE = bytes(c if not (33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126) else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    if not text:
        return []
    low = text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode()
    return low.translate(_SPACE).split()


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a machine word of ``a`` at a time."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        m = masks.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


class Items:
    """The benchmark: its vocabulary and its items as word numbers."""

    def __init__(self, rows: list[tuple]) -> None:
        self.rows = rows
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.words = [], []
        for item, text in rows:
            found = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text.encode() if text is not None else None)]
            if found:
                self.ids.append(item)
                self.words.append(found)

    def flat(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all texts, -1 for other words; words of each text)."""
        get = self.vocabulary.get
        parts = []
        for t in texts:
            parts.append(np.array([get(w, -1) for w in words(t)], np.int32))
        lens = np.array([len(p) for p in parts], np.int64)
        return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), lens


def _blocks(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block number of every word, first block of every text); a text has whole blocks of its own."""
    per = -(-lens // BLOCK)
    first = np.cumsum(per) - per
    begin = np.cumsum(lens) - lens
    return np.repeat(first, lens) + (np.arange(int(lens.sum())) - np.repeat(begin, lens)) // BLOCK, first


def _counts(unit: np.ndarray, ids: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, term, times) of the words with a number."""
    has = ids >= 0
    key, times = np.unique(unit[has] * n_terms + ids[has], return_counts=True)
    return key // n_terms, key % n_terms, times


def passages(items: Items, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The items' passages as sparse rows of length 1: (item of each, first entry of each, term, value)."""
    owner, size, terms, values = [], [], [np.zeros(0, np.int32)], [np.zeros(0)]
    for i, x in enumerate(items.words):
        for at in range(0, max(1, len(x) - BLOCK), BLOCK):
            term, times = np.unique(np.array(x[at : at + 2 * BLOCK], np.int32), return_counts=True)
            value = times * weight[term]
            term, value = term[value > 0], value[value > 0]
            if len(term):
                owner.append(i)
                size.append(len(term))
                terms.append(term)
                values.append(value / np.linalg.norm(value))
    return np.array(owner, np.int64), np.append(0, np.cumsum(size)).astype(np.int64), np.concatenate(terms), np.concatenate(values)


class Space:
    """Latent space of a group of item passages; its rank is that of the passages with the leading directions."""

    def __init__(self, owner: np.ndarray, size: np.ndarray, term: np.ndarray, value: np.ndarray, lead: np.ndarray) -> None:
        self.owner = owner
        self.terms, at = np.unique(term, return_inverse=True)
        q = np.zeros((len(owner), len(self.terms)))
        q[np.repeat(np.arange(len(owner)), size), at] = value
        rows = np.vstack([lead[self.terms].T, q])
        values, vectors = np.linalg.eigh(rows @ rows.T)  # SVD of the few rows
        good = values > 1e-12 * values[-1]
        self.basis = (rows.T @ (vectors[:, good] / np.sqrt(values[good]))).astype(np.float32)
        latent = q.astype(np.float32) @ self.basis
        self.latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
        # the most that a term can add to the cosine with any item of the group, of a family
        self.top = q.max(axis=0)
        self.most = [q[f].max(axis=0) for f in families(self.latent @ self.latent.T, FAMILIES)]

    def search(self, place: np.ndarray, r: np.ndarray, t: np.ndarray, value: np.ndarray, full: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, passage's place in the group, cosine) of all pairs at or above the cosine, from the
        passages' entries and full lengths; ``place`` is scratch of -1, a number a word."""
        place[self.terms] = np.arange(len(self.terms))
        at = place[t]
        place[self.terms] = -1
        has = at >= 0
        if not has.all():
            r, at, value = r[has], at[has], value[has]
        bar = np.maximum((COSINE - SLACK) * full, 1e-12)
        live = np.sqrt(np.bincount(r, weights=value * value, minlength=len(full))) >= bar
        live &= np.bincount(r, weights=value * self.top[at], minlength=len(full)) >= bar
        keep = live[r]
        r, at, value = r[keep], at[keep], value[keep]
        live = np.zeros(len(full), bool)
        for most in self.most:
            live |= np.bincount(r, weights=value * most[at], minlength=len(full)) >= bar
        keep = live[r]
        r, at, value = r[keep], at[keep], value[keep].astype(np.float32)
        if not len(r):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        new = np.flatnonzero(np.diff(r, prepend=-1))
        got = np.add.reduceat(self.basis[at] * value[:, None], new, axis=0)
        cosine = (got @ self.latent.T) / full[r[new]][:, None]
        a, b = np.nonzero(cosine >= COSINE)
        return r[new][a], b, cosine[a, b]


def fit(texts: DataFrame, items: Items) -> dict:
    """Weights and latent spaces from one column of all texts."""
    n = len(items.vocabulary)
    sc = texts.sparkSession.sparkContext
    shared = sc.broadcast(items.rows)

    def frequencies():
        items = Items(shared.value)

        def add(texts: list) -> np.ndarray:
            ids, lens = items.flat(texts)
            unit, _ = _blocks(lens)
            _, term, _ = _counts(unit, ids.astype(np.int64), n)
            return np.append(np.bincount(term, minlength=n), -(-lens // BLOCK).sum()).astype(float)

        return add

    df = sum_arrays(texts, frequencies, n + 1)
    total, df = max(df[-1], 1.0), df[:n]
    idf = np.log(1 + (total + 1) / (df + 1))
    common = df > COMMON * total
    for x in items.words:  # an item of common words only keeps them
        if common[x].all():
            common[x] = False
    other = float(idf[~common].mean()) if (~common).any() else 1.0
    weight = np.where(common, 0.0, idf)

    width = min(SKETCH, n)
    random = np.random.default_rng(SEED).standard_normal((n, width)).astype(np.float32)
    sketch = sc.broadcast((random, weight.astype(np.float32), other))

    def ranges():
        items, (random, weight, other) = Items(shared.value), sketch.value

        def add(texts: list) -> np.ndarray:
            out = np.zeros((n, width))
            ids, lens = items.flat(texts)
            unit, _ = _blocks(lens)
            rest = np.bincount(unit[ids < 0], minlength=int((-(-lens // BLOCK)).sum()))
            ids = np.where(weight[np.maximum(ids, 0)] > 0, ids, -1)
            unit, term, times = _counts(unit, ids.astype(np.int64), n)
            if not len(unit):
                return out.ravel()
            value = weight[term] * times
            new = np.flatnonzero(np.diff(unit, prepend=-1))
            length = np.sqrt(np.add.reduceat(value * value, new) + rest[unit[new]] * other * other)
            value = (value / np.repeat(length, np.diff(np.append(new, len(unit))))).astype(np.float32)
            y = np.add.reduceat(random[term] * value[:, None], new, axis=0)  # X W, a row a block
            y = np.repeat(y, np.diff(np.append(new, len(unit))), axis=0) * value[:, None]
            order = np.argsort(term, kind="stable")
            first = np.flatnonzero(np.diff(term[order], prepend=-1))
            out[term[order][first]] = np.add.reduceat(y[order], first, axis=0)
            return out.ravel()

        return add

    b = sum_arrays(texts, ranges, n * width).reshape(n, width) / total
    # single-pass range finder of the symmetric X'X: b (W'b)^-1 b' = L L'
    core = random.T.astype(float) @ b
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-9 * max(values.max(initial=0), 1e-12)
    lead = b @ (vectors[:, good] / np.sqrt(values[good]))
    return {"weight": weight.astype(np.float32), "other": other, "lead": lead.astype(np.float32), "rows": passages(items, weight)}


def _answer(x: list[int]) -> list[int]:
    return x[-((len(x) + 3) // 4):]


def _verify(x: list[int], around: np.ndarray) -> tuple[int, int]:
    """Best (words of the item in order, words of its answer) over windows of ``around``."""
    need = OVERLAP * len(x)
    width = len(x) + max(2, len(x) // 4)
    step = max(1, len(x) // 4)
    best = (0, 0)
    for at in range(0, max(1, len(around) - width + step), step):
        window = around[at : at + width]
        if np.isin(window, x).sum() < need:
            continue
        window = window.tolist()
        got = lcs(x, window)
        if got >= need and got > best[0]:
            best = (got, lcs(_answer(x), window))
            if got == len(x):
                break
    return best


HIT = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("common_words", T.IntegerType()),
                                T.StructField("item_words", T.IntegerType()), T.StructField("cosine", T.DoubleType())]))


class Finder:
    """Looks for the items in lists of texts."""

    def __init__(self, items: Items, model: dict) -> None:
        self.items, self.weight, self.other = items, model["weight"], model["other"]
        self.lead, self.rows = model["lead"], model["rows"]
        self.kept: dict[int, Space] = {}

    def spaces(self) -> Iterator[Space]:
        """The space of one group after another; the first ``KEPT`` stay in memory, others are fitted anew."""
        owner, start, term, value = self.rows
        for lo in range(0, len(owner), GROUP):
            space = self.kept.get(lo)
            if space is None:
                hi = min(lo + GROUP, len(owner))
                part = slice(start[lo], start[hi])
                space = Space(owner[lo:hi], np.diff(start[lo : hi + 1]), term[part], value[part], self.lead)
                if len(self.kept) < KEPT:
                    self.kept[lo] = space
            yield space

    def candidates(self, ids: np.ndarray, lens: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(text, item, first word of the passage in the text, cosine) of all pairs at or above the cosine."""
        n, weight = len(self.items.vocabulary), self.weight
        unit, first = _blocks(lens)
        per = -(-lens // BLOCK)
        n_units = int(per.sum())
        text_of = np.repeat(np.arange(len(lens)), per)
        rest = np.bincount(unit[ids < 0], minlength=n_units) * self.other**2
        useful = np.where(weight[np.maximum(ids, 0)] > 0, ids, -1).astype(np.int64)
        useful[ids < 0] = -1
        joins = np.append(text_of[1:] == text_of[:-1], False)  # a passage is a block and the next of its text
        block, term, times = _counts(unit, useful, n)
        start = np.searchsorted(block, np.arange(n_units + 1))
        parts = []
        for lo in range(0, n_units, 20_000):
            p = np.arange(lo, min(lo + 20_000, n_units))
            after = np.minimum(p + 1, n_units - 1)
            size = start[p + 1] - start[p] + np.where(joins[p], start[after + 1] - start[after], 0)
            row = np.repeat(np.arange(len(p)), size)  # both blocks' terms stand next to each other
            at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start[p], size)
            key, inverse = np.unique(row * n + term[at], return_inverse=True)
            r, t = key // n, key % n
            value = np.bincount(inverse, weights=times[at], minlength=len(key)) * weight[t]
            mass = np.bincount(r, weights=value * value, minlength=len(p))
            full = np.sqrt(mass + rest[p] + np.where(joins[p], rest[after], 0))
            keep = (np.sqrt(mass) >= (COSINE - SLACK) * full)[r]
            if keep.any():
                parts.append((p, full, r[keep].astype(np.int32), t[keep].astype(np.int32), value[keep]))
        place = np.full(n, -1, np.int32)
        for space in self.spaces() if parts else ():
            for p, full, r, t, value in parts:
                a, b, cosine = space.search(place, r, t, value, full)
                where = p[a]
                yield from zip(text_of[where].tolist(), space.owner[b].tolist(), ((where - first[text_of[where]]) * BLOCK).tolist(), cosine.tolist())

    def find(self, texts: list) -> list[list[dict]]:
        hits: list[list[dict]] = [[] for _ in texts]
        ids, lens = self.items.flat(texts)
        if not len(ids) or not len(self.rows[0]):
            return hits
        begin = np.cumsum(lens) - lens
        places: dict[tuple[int, int], list] = {}
        for text, item, at, c in self.candidates(ids, lens):
            places.setdefault((text, item), []).append((c, at))
        for (text, item), found in sorted(places.items()):
            x = self.items.words[item]
            own = ids[begin[text] : begin[text] + lens[text]]
            for c, at in sorted(found, reverse=True):
                common, answer = _verify(x, own[max(0, at - len(x)) : at + 2 * BLOCK + len(x)])
                if common and answer >= ANSWER * len(_answer(x)):
                    hits[text].append({"item_id": self.items.ids[item], "common_words": common, "item_words": len(x), "cosine": c})
                    break
        return hits


HIT = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("common_words", T.IntegerType()),
                                T.StructField("item_words", T.IntegerType()), T.StructField("cosine", T.DoubleType())]))


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", out: str = "hits") -> DataFrame:
    """``docs`` with an array of the benchmark items found in each text (empty: clean)."""
    rows = benchmark.select(F.col(item_col).cast("long"), F.col(item_text_col)).limit(MAX_ITEMS + 1).collect()
    if len(rows) > MAX_ITEMS:
        raise ValueError(f"the benchmark has over {MAX_ITEMS} items; search it in parts")
    items = Items([tuple(r) for r in rows])
    if not items.ids:
        return docs.withColumn(out, F.array().cast(HIT))
    model = fit(docs.select(text_col), items)
    shared = docs.sparkSession.sparkContext.broadcast((items.rows, model))

    def make():
        finder = Finder(Items(shared.value[0]), shared.value[1])
        kind = T_to_arrow(HIT)
        return lambda texts: [pa.array([h for lo, hi in slabs(texts) for h in finder.find(texts[lo:hi])], type=kind)]

    return per_batch(docs, text_col, [(out, HIT)], make)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents in which no benchmark item was found."""
    hits = spare_name(docs.columns, "hits")
    return contaminated(docs, benchmark, text_col, out=hits).filter(F.size(hits) == 0).drop(hits)
