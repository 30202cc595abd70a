"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are made beside the scan. Only distinct fingerprints are compared. They are spread
over buckets by a pigeonhole rule: of ``BLOCKS`` blocks of bits, two fingerprints within
``max_bits`` share at least ``BLOCKS - max_bits`` unchanged ones, so every pair meets in the bucket
of some choice of that many blocks. Each bucket is a subtree of a binary trie over the 64 bits; a
task walks pairs of trie nodes together from the top, adds up the bits in which the two branches
differ, and drops a pair of nodes once that exceeds the budget. Node pairs whose fingerprints
are already connected are dropped too. A bucket reports a star of links for each of its connected
sets (so a group of near copies never becomes all its pairs), and the stars are joined by
large-star / small-star rounds into components.

A bucket with over ``split`` fingerprints is cut into parts by hash; each pair of parts is a group
of its own, so that a hot bucket is work for many tasks and none holds more than two parts.

Defined cases: null, empty and white texts have fingerprint 0 and link like any other; repeated
rows share a component; rows with a null id get the component of their fingerprint (null if no
member has an id). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import cut, per_batch, spare_name

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Block widths; 64 bits. Six blocks with four bits to differ: two blocks always agree.
BLOCKS = (11, 11, 11, 11, 10, 10)
SPLIT = 2048
#: Node pairs walked at once in a task; bounds its memory.
FRONT = 200_000


def fingerprint(text: bytes | None, k: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the k-word shingles (repeats included) of a text, A-Z lower-cased."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= k:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fp", k: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the fingerprint of each text as a signed long."""

    def make():
        return lambda texts: [np.array([fingerprint(t, k) for t in texts], np.uint64).view(np.int64)]

    return per_batch(docs, text_col, [(out, T.LongType())], make)


# ---- the trie walk inside a task


def _roots(labels: np.ndarray) -> np.ndarray:
    while True:
        up = labels[labels]
        if np.array_equal(up, labels):
            return labels
        labels = up


def _union(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member as the label of each set after joining a[i] with b[i]."""
    while len(a):
        ra, rb = labels[a], labels[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(labels, np.maximum(ra, rb), np.minimum(ra, rb))
        labels = _roots(labels)
    return labels


def trie_links(group: np.ndarray, codes: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Label (position of the smallest member) of each code's connected set within its group.
    Rows must be sorted by (group, code as unsigned); codes are distinct within a group."""
    n = len(codes)
    labels = np.arange(n)
    if n < 2:
        return labels
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    last = np.concatenate([first[1:], [n]])
    big = last - first > 1
    lo, hi = first[big], last[big]
    ones: dict[int, np.ndarray] = {}

    def split(bit: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if bit not in ones:
            if len(ones) > 8:
                ones.clear()
            ones[bit] = np.concatenate([[0], np.cumsum((codes >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        c = ones[bit]
        return hi - (c[hi] - c[lo])

    stack = [(63, lo, hi, lo, hi, np.zeros(len(lo), np.int8))]
    while stack:
        bit, alo, ahi, blo, bhi, diff = stack.pop()
        if len(alo) > FRONT:
            half = len(alo) // 2
            stack.append((bit, *(x[half:] for x in (alo, ahi, blo, bhi, diff))))
            stack.append((bit, *(x[:half] for x in (alo, ahi, blo, bhi, diff))))
            continue
        # node pairs that are one connected set already have nothing to add
        change = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])
        done = (change[ahi - 1] == change[alo]) & (change[bhi - 1] == change[blo]) & (labels[alo] == labels[blo])
        single = (ahi - alo == 1) & (bhi - blo == 1) & ~done
        if single.any():
            a, b, d = alo[single], blo[single], diff[single]
            low = np.uint64((1 << (bit + 1)) - 1)
            near = d + np.bitwise_count((codes[a] ^ codes[b]) & low) <= max_bits
            labels = _union(labels, a[near], b[near])
        go = ~(done | single)
        alo, ahi, blo, bhi, diff = alo[go], ahi[go], blo[go], bhi[go], diff[go]
        if not len(alo) or bit < 0:
            continue
        am, bm = split(bit, alo, ahi), split(bit, blo, bhi)
        same = alo == blo
        other = ~same
        cross = diff < max_bits
        branches = [  # (0,1) and (1,0) cost a bit; of a node with itself only one of them is new
            (alo, am, bm, bhi, diff + 1, cross), (am, ahi, blo, bm, diff + 1, cross & other),
            (am, ahi, bm, bhi, diff, None), (alo, am, blo, bm, diff, None)]
        parts: dict[bool, list] = {True: [], False: []}
        for xlo, xhi, ylo, yhi, d, keep in branches:
            ok = (xhi > xlo) & (yhi > ylo) & ~((xlo == ylo) & (xhi - xlo == 1))
            if keep is not None:
                ok &= keep
            if ok.any():
                parts[keep is None].append([x[ok] for x in (xlo, xhi, ylo, yhi, d)])
        for near_first in (False, True):  # equal branches are walked first: they connect the most
            if parts[near_first]:
                stack.append((bit - 1, *(np.concatenate(c) for c in zip(*parts[near_first]))))
    return _roots(labels)


def _walk(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group (key, i, j); whole groups are walked, about a batch at a time."""
    held: list[np.ndarray] = []

    def done(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = np.any(rows[1:, :3] != rows[:-1, :3], axis=1)
        group = np.concatenate([[0], np.cumsum(step)])
        codes = rows[:, 3].view(np.uint64) if rows[:, 3].flags.c_contiguous else np.ascontiguousarray(rows[:, 3]).view(np.uint64)
        order = np.lexsort((codes, group))
        group, codes = group[order], codes[order]
        labels = trie_links(group, codes, max_bits)
        links = np.flatnonzero(labels != np.arange(len(labels)))
        signed = codes.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(signed[links]), pa.array(signed[labels[links]])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.int64))
        rows = np.concatenate(held)
        ends = np.flatnonzero(np.any(rows[1:, :3] != rows[:-1, :3], axis=1))
        if len(ends) and len(rows) > 50_000:
            yield from done(rows[: ends[-1] + 1])
            rows = rows[ends[-1] + 1 :]
        held = [rows]
    if held and len(held[0]):
        yield from done(np.concatenate(held))


# ---- links and components as DataFrames


def _block(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, sum(BLOCKS[:i])).bitwiseAND(F.lit((1 << BLOCKS[i]) - 1).cast("long"))


def links(codes: DataFrame, max_bits: int = MAX_BITS, split: int = SPLIT) -> DataFrame:
    """Links (a, b) that connect all pairs of distinct long ``fp`` within ``max_bits``."""
    choose = len(BLOCKS) - max_bits
    if choose < 1:
        raise ValueError(f"max_bits must be below {len(BLOCKS)}")
    fp = F.col("fp")
    keys = []
    for n, blocks in enumerate(combinations(range(len(BLOCKS)), choose)):
        key = F.lit(n).cast("long")
        for i in blocks[:2]:  # two blocks name a bucket; more would only make buckets smaller
            key = F.shiftleft(key, BLOCKS[i]).bitwiseOR(_block(fp, i))
        keys.append(key)
    spread = codes.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / split).cast("int")
    rows = (spread.join(sizes, "key")
            .withColumn("m", parts)
            .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("m")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
            .select("key", F.least("own", "other").cast("long").alias("i"), F.greatest("own", "other").cast("long").alias("j"), "fp"))
    grouped = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return grouped.mapInArrow(lambda batches: _walk(batches, max_bits), "a long, b long").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """Smallest reachable node ``b`` of every node ``a`` that isn't its own, by large-star and
    small-star rounds; each round's edges are written to the shared folder."""
    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    state = _state(e)
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.*").filter("a <> b").distinct())
        e = cut(small)
        now = _state(e)
        if now == state:
            return e
        state = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: its id, ``fp`` (signed long) and ``component`` (smallest id
    reachable over links of ``max_bits`` or fewer differing bits)."""
    marked = cut(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), k=k).select("id", "fp"))
    codes = cut(marked.groupBy("fp").agg(F.min("id").alias("low")))
    reach = connected(links(codes.select("fp"), max_bits))
    roots = codes.join(reach.withColumnRenamed("a", "fp"), "fp", "left").select("fp", "low", F.coalesce("b", "fp").alias("root"))
    # written first: an aggregate right under the join would keep AQE from splitting a large component's rows
    lowest = cut(roots.groupBy("root").agg(F.min("low").alias("component")))
    named = roots.join(lowest, "root").select("fp", "component")
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents that stay: of each component the one with the smallest id. Of repeated rows
    with that id one stays; a component without any id keeps one row of its smallest fingerprint."""
    found = cut(near_duplicates(docs, id_col, text_col, k, max_bits))
    mark = spare_name(docs.columns, "keepers")
    keep = (found.filter(F.col(id_col) == F.col("component")).groupBy(id_col).agg(F.count(F.lit(1)).alias(mark)))
    kept = docs.join(keep, id_col).select(*docs.columns, mark)
    out = kept.filter(F.col(mark) == 1).drop(mark).union(kept.filter(F.col(mark) > 1).drop(mark).dropDuplicates([id_col]))
    if not found.filter("component is null").limit(1).count():
        return out
    fp = spare_name(docs.columns, "fp")
    bare = fingerprints(docs.filter(F.col(id_col).isNull()), text_col, fp, k)
    lonely = found.filter("component is null").select(F.col("fp").alias(fp)).distinct()
    # without ids a component is named by its smallest fingerprint
    reach = connected(links(lonely.select(F.col(fp).alias("fp")), max_bits)).select(F.col("a").alias(fp))
    firsts = lonely.join(reach, fp, "left_anti")
    return out.union(bare.join(firsts, fp, "left_semi").dropDuplicates([fp]).select(*docs.columns))
