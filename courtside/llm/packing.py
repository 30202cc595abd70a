"""Vector best-fit packing of documents into training sequences.

A document is its token ids and one end id. Documents over a sequence's capacity are cut into
full pieces and a last, shorter one; no other document is cut. A piece takes three things from a
sequence: its tokens, one of the documents the sequence may hold, and its attention cost (the
square of its length). Pieces go in by falling length; among the open sequences that have room
for a piece under every constraint, vector best-fit takes the one whose residual capacities score
best: least weighted norm of what would be left (``norm``), or largest weighted dot product of the
piece with what is there (``dot``). A sequence that is chosen takes as many pieces of this length as
it can; if none fits, a new one is opened. Equal scores go to the sequence opened first.

A piece's demands follow from its length alone, so pieces of one length are interchangeable and
open sequences with the same residual capacities too. The packing is therefore planned over the
histogram of lengths (at most ``capacity`` numbers, whatever the corpus) as runs: "pieces
``rank .. rank + n`` of length L lie in sequences ``first .. first + n`` at one offset". Spark counts
the histogram, ranks the pieces within their length in salted blocks, and looks each rank up in
the runs. Texts are read once and never shuffled.

Defined cases: null and empty texts, and texts without a token, are the end id alone (one piece of
length 1). Null and repeated ids are kept, row by row. An empty table gives an empty result. Texts
are tokenised whole, however long (up to Arrow's 2 GB a text). Only the id and the
text column are read; other columns, whatever their names, don't matter. Strings of the
vocabulary's special tokens in a text become those tokens, as the tokenizer does by default. A
piece whose own cost or length no sequence allows gets a sequence of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import Numbers, cut

CAPACITY = 2048
#: Weights of residual tokens, documents and cost, each as a share of a sequence's capacity.
WEIGHTS = (1.0, 0.1, 0.1)
#: Distinct words whose ids a task keeps; beyond that it forgets all and starts again.
KEPT_WORDS = 600_000
#: Bytes of texts that are split into words at once.
SLAB = 8_000_000
#: Pieces of one length that are ranked in one group.
BLOCK = 2_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def read_vocabulary(path: str | None = None) -> str:
    """A tokenizer file (some MB), by default the public ``word_bpe_49k``; executors get it as a broadcast."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


class WordTokens:
    """Ids of texts by way of their distinct words. White space ends tokens in a vocabulary that
    drops it, so a text's ids are its words' ids in a row. Of a vocabulary that lower-cases, words are
    told apart by their lower-cased A-Z only, unless they may hold a special token.

    Punctuation at a word's end is set apart where the vocabulary does so itself, which leaves fewer words.
    Many words are tokenised in one call. Letters alone are one part to the vocabulary's rule and its last
    token is marked as an end, which tells such words apart; other words are set apart by a special token.
    """

    MARK = "<|startoftext|>"
    PUNCTUATION = ",.;:!?"

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.mark = self.tokenizer.token_to_id(self.MARK)
        lowers = self.tokenizer.normalizer
        self.lower = lowers is not None and lowers.normalize_str("AZ") == "az"
        # whether punctuation after letters is a part of its own to the vocabulary's rule
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.cuts = all(ids(f"ab{x}") == ids(f"ab {x}") for x in (*self.PUNCTUATION, self.PUNCTUATION))
        known = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(known.values()) + 1, bool)
        self.ends[[i for t, i in known.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.number, self.flat, self.starts = Numbers(), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _apart(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of any words."""
        encode = self.tokenizer.encode_batch_fast
        if self.mark is not None and not any("<|" in w for w in words):
            ids = np.array(encode([self.MARK.join(words)], add_special_tokens=False)[0].ids, np.uint32)
            marks = np.flatnonzero(ids == self.mark)
            return ids[ids != self.mark], np.diff(marks, prepend=-1, append=len(ids)) - 1
        each = [e.ids for e in encode(words, add_special_tokens=False)]
        return np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each], np.int64)

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of letters."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words) or not len(last) or last[-1] != len(ids) - 1:  # not one part each after all
            return self._apart(words)
        return ids, np.diff(last, prepend=-1)

    def learn(self) -> None:
        """Tokenise the words numbered since."""
        words = [w.decode("utf-8", "replace") for w in islice(self.number, len(self.starts) - 1, None)]
        plain = np.fromiter(map(str.isalpha, words), bool, len(words))
        size = np.zeros(len(words), np.int64)
        flat, owner = [], []
        for kind, make in ((True, self._letters), (False, self._apart)):
            these = np.flatnonzero(plain == kind)
            for lo in range(0, len(these), 1000):
                some = these[lo : lo + 1000]
                ids, n = make([words[i] for i in some])
                size[some] = n
                flat.append(ids)
                owner.append(np.repeat(some, n))
        if flat:
            order = np.argsort(np.concatenate(owner), kind="stable")
            self.flat = np.concatenate([self.flat, np.concatenate(flat)[order]])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(size)])

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of an Arrow column; null is empty."""
        if len(self.number) > KEPT_WORDS:
            self.forget()
        texts = pc.fill_null(texts, "")
        if self.lower:
            texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        if self.cuts:
            texts = pc.replace_substring_regex(texts, rf"([a-z])([{self.PUNCTUATION}]+)(\s)", r"\1 \2\3")
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        spelt = words.dictionary.cast(pa.binary()).to_pylist()
        number = np.fromiter(map(self.number.__getitem__, spelt), np.int64, len(spelt))
        if len(self.number) > len(self.starts) - 1:
            self.learn()
        at = number[words.indices.to_numpy()] if len(spelt) else np.zeros(0, np.int64)
        begin = self.starts[at]
        size = self.starts[at + 1] - begin
        ends = np.cumsum(size)
        flat = self.flat[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        upto = np.cumsum(pc.list_value_length(split).to_numpy())
        return np.split(flat, np.concatenate([[0], ends])[upto][:-1])


def slabs_of(texts: pa.Array, most: int = SLAB) -> Iterator[tuple[int, int]]:
    """Ranges of a column with about ``most`` bytes each (one text at least), to bound memory."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32`` and ``at``, a number of its own."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary file
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(shared.value)
        seen = TaskContext.get().partitionId() << 38
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for lo, hi in slabs_of(texts):
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(tokens.ids(texts.slice(lo, hi - lo)), lo):
                    whole = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(whole), capacity)):
                        x = whole[s : s + capacity]
                        row.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(len(x))
                        crc.append(zlib.crc32(x))
                at = np.arange(seen, seen + len(row))
                seen += len(row)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(row, pa.int64())), *(pa.array(x, k) for x, k in zip((piece, start, length, crc, at), kinds))], names=names)

    return rows.mapInArrow(run, f"{PIECES}, at long")


def plan(histogram: dict[int, int], capacity: int = CAPACITY, most_docs: int | None = None, most_cost: int | None = None,
         weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm") -> np.ndarray:
    """Runs ``(length, first rank, pieces, first sequence, offset)`` for pieces counted by length.

    The open sequences are kept as groups of neighbours with equal residual capacities."""
    most_docs = most_docs or capacity
    most_cost = most_cost or capacity * capacity
    full = np.array([capacity, most_docs, most_cost], np.int64)
    scale = np.asarray(weights, float)
    rooms = np.zeros((0, 3), np.int64)  # residual tokens, documents and cost of a group
    first, size, used = (np.zeros(0, np.int64) for _ in range(3))
    runs: list[tuple[int, int, int, int, int]] = []
    opened = 0
    lengths = sorted((n for n, c in histogram.items() if c), reverse=True)
    for length in lengths:
        left, rank = histogram[length], 0
        need = np.array([length, 1, length * length], np.int64)
        fits = (rooms >= need).all(axis=1)
        if rule == "norm":
            score = ((((rooms - need) / full) ** 2) * scale).sum(axis=1)
        else:
            score = -((rooms / full) * (need / full) * scale).sum(axis=1)
        order = np.lexsort((first, score))
        made: list[tuple[np.ndarray, int, int, int]] = []
        gone: list[int] = []

        def fill(room: np.ndarray, at: int, bins: int, offset: int, each: int) -> None:
            """``each`` pieces into each of ``bins`` sequences from ``at``."""
            nonlocal rank, left
            for k in range(each):
                runs.append((length, rank, bins, at, offset + k * length))
                rank += bins
            left -= each * bins
            made.append((np.maximum(room - each * need, 0), at, bins, offset + each * length))

        for g in order[fits[order]]:
            if not left:
                break
            room, at, bins, offset = rooms[g], int(first[g]), int(size[g]), int(used[g])
            each = int((room // need).min())
            whole = min(bins, left // each)
            if whole:
                fill(room, at, whole, offset, each)
            if left and whole < bins:  # fewer than a sequence takes
                fill(room, at + whole, 1, offset, left)
                whole += 1
            if whole < bins:
                made.append((room, at + whole, bins - whole, offset))
            gone.append(g)
        if left:
            each = max(1, int((full // need).min()))
            whole, rest = divmod(left, each)
            for bins, take in ((whole, each), (1, rest)):
                if bins and take:
                    fill(full, opened, bins, 0, take)
                    opened += bins
        keep = np.ones(len(rooms), bool)
        keep[gone] = False
        if made:
            rooms = np.concatenate([rooms[keep], np.array([m[0] for m in made])])
            first, size, used = (np.concatenate([x[keep], np.array([m[k] for m in made], np.int64)]) for k, x in ((1, first), (2, size), (3, used)))
        open_still = (rooms >= np.array([lengths[-1], 1, lengths[-1] ** 2])).all(axis=1)
        rooms, first, size, used = rooms[open_still], first[open_still], size[open_still], used[open_still]
    return np.array(runs, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0,
         most_docs: int | None = None, most_cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece.

    ``most_docs`` and ``most_cost`` bound a sequence's documents and the sum of its squared lengths;
    by default they are what ``capacity`` tokens can reach at all."""
    spark = docs.sparkSession
    cut_up = cut(pieces(docs, vocabulary, id_col, text_col, capacity, end_id))
    counted = cut_up.groupBy("length").count()  # at most ``capacity`` rows
    histogram = {r["length"]: r["count"] for r in counted.toLocalIterator()}
    runs = plan(histogram, capacity, most_docs, most_cost, weights, rule)

    # ranks within a length: blocks of about BLOCK pieces, numbered one after another
    blocks = spark.createDataFrame([(n, 1 + c // BLOCK) for n, c in histogram.items()], "length long, blocks long")
    rows = cut_up.join(F.broadcast(blocks), "length").withColumn("block", F.pmod(F.xxhash64("at"), F.col("blocks")))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    firsts = rows.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n")).select("length", "block", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "block").orderBy("at"))
    ranked = rows.withColumn("own", own).join(firsts, ["length", "block"]).withColumn("rank", F.col("before") + F.col("own") - 1)

    key = runs[:, 0] * (1 << 44) + runs[:, 1]
    order = np.argsort(key, kind="stable")
    shared = spark.sparkContext.broadcast((key[order], runs[order]))  # bounded by lengths, not by pieces

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = shared.value
        for batch in batches:
            if batch.num_rows:
                length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
                run = table[np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
