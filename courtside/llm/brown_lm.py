"""Scores texts with a Brown class-based bigram model trained on the corpus itself.

``p(text) = prod p(class | class before) p(word | class)``, from a begin to an end mark.
Classes come from exchange clustering. Its symbols are the ``SYMBOLS`` most frequent words and, for all
other words, ``ENDINGS`` buckets of their last bytes. Spark counts symbol bigrams over the whole corpus;
each sweep adds up, on Spark, every symbol's bigrams with the present classes (symbols x classes,
whatever the corpus size), and symbols move to the class that raises the likelihood of the
class bigrams most, half of the symbols at a time. Class transitions are smoothed with class
frequencies, word emissions add one half to the count of each of the class' words and of one unknown.

Word counts cover all training words. The ``HEAD`` most frequent ones are broadcast with their
counts; every other word of a text gets its count from a shuffle join, once a text and word. So
memory doesn't grow with the vocabulary and a frequent word is never a join key.

Defined cases: a null or empty text is the end mark alone. Without training rows, words are unknown and
all classes alike. Count ties at the head's edge stay out of the head (the join serves them); ties of
classes go to the first. Repeated rows are scored each; a null id counts as bucket 0.
Texts are scored whole, however long; result columns take the place of equal-named ones.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import cut, raw_texts, slabs, sum_batches

CLASSES = 64
SYMBOLS, ENDINGS = 2048, 2048
ENDING_BYTES = 3
HEAD = 200_000
SWEEPS = 10
SMOOTH = 5.0
#: Word forms counted in a task before it passes them on.
FORMS = 400_000


def tokens(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def ending(word: bytes) -> int:
    return SYMBOLS + zlib.crc32(word[-ENDING_BYTES:]) % ENDINGS


def count_words(texts: DataFrame) -> DataFrame:
    """(word as binary, n) over one column of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for t in raw_texts(batch.column(0)):
                counts.update(tokens(t))
                if len(counts) > FORMS:
                    yield out()
        if counts:
            yield out()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head_words(words: DataFrame, most: int = HEAD) -> list[tuple[bytes, int]]:
    """Words at or above the lowest count that at most ``most`` words reach, most frequent first."""
    bars = sorted(((r["n"], r["words"]) for r in words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).toLocalIterator()), reverse=True)
    least, total = None, 0
    for n, k in bars:
        total += k
        if total > most:
            break
        least = n
    if least is None:
        return []
    return sorted(((bytes(r["word"]), r["n"]) for r in words.filter(F.col("n") >= least).toLocalIterator()), key=lambda x: (-x[1], x[0]))


def count_bigrams(texts: DataFrame, symbols: dict[bytes, int]) -> DataFrame:
    """(a, b, n): neighbouring symbols in one column of texts; ``SYMBOLS + ENDINGS`` is the mark at both ends."""
    shared = texts.sparkSession.sparkContext.broadcast(symbols)
    size, mark = SYMBOLS + ENDINGS + 1, SYMBOLS + ENDINGS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(shared.value)
        for batch in batches:
            found = raw_texts(batch.column(0))
            for lo, hi in slabs(found):
                if len(known) > FORMS:
                    known = dict(shared.value)
                parts = [np.array([mark])]
                for t in found[lo:hi]:
                    words = tokens(t)
                    ids = [known.get(w, -1) for w in words]
                    if -1 in ids:
                        ids = [k if k >= 0 else known.setdefault(w, ending(w)) for w, k in zip(words, ids)]
                    parts.append(np.array([*ids, mark]))
                ids = np.concatenate(parts)
                key, n = np.unique(ids[:-1] * size + ids[1:], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((key // size).astype(np.int32)), pa.array((key % size).astype(np.int32)), pa.array(n)], names=["a", "b", "n"])

    return texts.mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def context_sums(bigrams: DataFrame, classes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(bigrams of each symbol with the class after it, with the class before it): one aggregate on
    Spark, symbols x classes rows of which come to the driver."""
    size = len(classes)
    known = bigrams.sparkSession.createDataFrame(list(enumerate(classes.tolist())), "symbol int, class int")
    first = F.broadcast(known.select(F.col("symbol").alias("a"), F.col("class").alias("class_a")))  # a row a symbol
    second = F.broadcast(known.select(F.col("symbol").alias("b"), F.col("class").alias("class_b")))
    sides = bigrams.join(first, "a").join(second, "b").selectExpr("n", f"stack(2, a, class_b, b, class_a + {k}) as (symbol, context)")
    got = sides.groupBy("symbol", "context").agg(F.sum("n").alias("n")).toArrow()
    symbol, context, n = (got.column(c).to_numpy() for c in ("symbol", "context", "n"))
    both = np.zeros((size, 2 * k))
    both[symbol, context] = n
    return both[:, :k], both[:, k:]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(after: np.ndarray, before: np.ndarray, classes: np.ndarray, movable: np.ndarray, fixed: int) -> tuple[np.ndarray, int]:
    """Moves symbols one after another to the class of highest gain; class ``fixed`` takes none.
    ``after`` and ``before`` are the symbols' bigrams with the classes as they were."""
    k = after.shape[1]
    table = np.zeros((k, k))
    np.add.at(table, classes, after)
    out, moves = classes.copy(), 0
    for w in movable[np.argsort(-after[movable].sum(axis=1), kind="stable")]:
        r, p, g = after[w], before[w], out[w]
        if not r.any() and not p.any():
            continue
        table[g] -= r
        table[:, g] -= p
        np.maximum(table, 0, out=table)
        # its neighbours' rows and columns get their bigrams back wherever it goes
        row, col, n = table.sum(axis=1) + p, table.sum(axis=0) + r, (r.sum(), p.sum())
        gain = (_xlogx(table + r).sum(axis=1) - _xlogx(table).sum(axis=1) + _xlogx(table + p[:, None]).sum(axis=0) - _xlogx(table).sum(axis=0)
                - _xlogx(row + n[0]) + _xlogx(row) - _xlogx(col + n[1]) + _xlogx(col))
        d = np.diag(table)  # the cell of a class with itself gets both
        gain += _xlogx(d + r + p) + _xlogx(d) - _xlogx(d + r) - _xlogx(d + p)
        gain[fixed] = -np.inf
        h = int(gain.argmax())
        if gain[h] <= gain[g] + 1e-9:
            h = int(g)
        moves += h != g
        out[w] = h
        table[h] += r
        table[:, h] += p
    return out, moves


def cluster(bigrams: DataFrame, k: int = CLASSES, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """(class of every symbol, class bigrams). The mark has the last class for itself."""
    size, mark = SYMBOLS + ENDINGS + 1, SYMBOLS + ENDINGS
    classes = np.arange(size) % (k - 1)
    classes[mark] = k - 1
    for sweep in range(sweeps):
        after, before = context_sums(bigrams, classes, k)
        half = np.arange(mark)
        half = half[(half // (k - 1) + half + sweep) % 2 == 0]
        classes, moves = exchange(after, before, classes, half, k - 1)
        if sweep and not moves:
            break
    after, _ = context_sums(bigrams, classes, k)
    table = np.zeros((k, k))
    np.add.at(table, classes, after)
    return classes, table


def train(docs: DataFrame, text_col: str = "text") -> tuple[dict, DataFrame]:
    """The model from all rows of ``docs``, and the table of all word counts (word, n)."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = cut(count_words(texts))
    end = texts.count()
    head = head_words(words)
    symbols = {w: i for i, (w, _) in enumerate(head[:SYMBOLS])}
    symbols |= {w: ending(w) for w, _ in head[SYMBOLS:]}
    bigrams = cut(count_bigrams(texts, symbols))  # at most (symbols + endings + 1) ** 2 rows at any corpus size
    classes, table = cluster(bigrams)
    shared = docs.sparkSession.sparkContext.broadcast((symbols, classes))

    def work():
        symbols, classes = shared.value

        def add(batch: pa.RecordBatch) -> np.ndarray:
            c = classes[[symbols[w] if w in symbols else ending(w) for w in batch.column(0).to_pylist()]]
            n = batch.column(1).to_numpy(zero_copy_only=False)
            return np.concatenate([np.bincount(c, weights=n, minlength=CLASSES), np.bincount(c, minlength=CLASSES)])

        return add

    by_class = sum_batches(words, work, 2 * CLASSES)
    mass, types = by_class[:CLASSES], by_class[CLASSES:]
    seen = float(mass.sum() + end)
    total = table.sum(axis=0) + 0.5
    share = total / total.sum()
    move = np.log10((table + SMOOTH * share) / (table.sum(axis=1, keepdims=True) + SMOOTH))
    model = {"head": [w for w, _ in head], "counts": np.array([n for _, n in head], float), "classes": classes, "move": move,
             "scale": np.log10(mass + 0.5 * (types + 1)), "tokens": int(seen), "types": int(types.sum()) + (end > 0), "end": end}
    return model, words


def score(docs: DataFrame, model: dict, words: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, plus n_tokens, n_known, train_tokens, base_score and score, which take
    the place of columns of these names (in any case)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    results = {"n_tokens", "n_known", "train_tokens", "base_score", "score"}
    plain = [c for c in docs.columns if c != text_col and c.lower() not in results]
    # columns are numbered while this goes on, so that no name of theirs meets one of its own
    keep = [f"own_{i}" for i in range(len(plain))]
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(plain, keep)], F.col(f"`{text_col}`").alias("lm_text"))
    kinds = [("lm_tokens", pa.int64()), ("lm_known", pa.int64()), ("lm_counts", pa.float64()), ("lm_model", pa.float64())]
    pair = pa.struct([("word", pa.binary()), ("times", pa.int64())])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]),
                        "lm_tokens long, lm_known long, lm_counts double, lm_model double, lm_rest array<struct<word: binary, times: bigint>>"])
    names = [*keep, *(n for n, _ in kinds), "lm_rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        number = {w: i for i, w in enumerate(m["head"])}
        classes, move, scale = m["classes"], m["move"], m["scale"]
        mark = CLASSES - 1
        own = np.concatenate([classes[: min(SYMBOLS, len(m["head"]))], classes[[ending(w) for w in m["head"][SYMBOLS:]]]]).astype(np.int64)
        logs = np.log10(m["counts"] + 0.5)
        end = np.log10(m["end"] + 0.5)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for t in raw_texts(batch.column(batch.num_columns - 1)):
                found = tokens(t)
                ids = np.array([number.get(w, -1) for w in found], np.int64)
                inside = ids >= 0
                c = np.full(len(ids) + 2, mark)
                c[1:-1][inside] = own[ids[inside]] if len(own) else 0
                rest: Counter = Counter()
                for i in np.flatnonzero(~inside).tolist():
                    c[i + 1] = classes[ending(found[i])]
                    rest[found[i]] += 1
                counts = logs[ids[inside]].sum() if inside.any() else 0.0
                out[0].append(len(found) + 1)
                out[1].append(int(inside.sum()) + (m["end"] > 0))
                out[2].append(float(counts + end))  # log10(count + 1/2) of the words known here
                out[3].append(float(counts + move[c[:-1], c[1:]].sum() - scale[c[1:-1]].sum()))
                out[4].append([{"word": w, "times": n} for w, n in rest.items()])
            made = [pa.array(x, k) for x, (_, k) in zip(out, kinds)] + [pa.array(out[4], pa.list_(pair))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=names)

    # the written rows are fixed, and so are their numbers
    seen = cut(rows.mapInArrow(run, schema)).withColumn("lm_row", F.monotonically_increasing_id())
    rest = seen.select("lm_row", F.explode("lm_rest").alias("x")).select("lm_row", "x.word", "x.times")
    n = F.coalesce(F.col("n"), F.lit(0))
    sums = (rest.join(words, "word", "left")
            .groupBy("lm_row").agg(F.sum(F.col("times") * F.log10(n + 0.5)).alias("more"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("also")))
    size = float(np.log10(model["tokens"] + 0.5 * (model["types"] + 1)))
    more = F.coalesce(F.col("more"), F.lit(0.0))
    return (seen.drop("lm_rest").join(sums, "lm_row", "left")
            .select(*[F.col(k).alias(c) for k, c in zip(keep, plain)], F.col("lm_tokens").alias("n_tokens"), (F.col("lm_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
                    F.lit(model["tokens"]).cast("long").alias("train_tokens"),
                    (F.col("lm_counts") + more - F.col("lm_tokens") * size).alias("base_score"), (F.col("lm_model") + more).alias("score")))
