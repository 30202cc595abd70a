"""Helpers shared by the text operators: words, hold-out buckets, Arrow columns, cut points in a plan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.session import ensure_checkpoint_dir

#: A word is a run of anything but these bytes; ``bytes.split()`` cuts at exactly them.
WHITE = " \t\n\x0b\f\r"
WHITE_RE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's shared checkpoint folder and go on from there, so that a
    lost executor costs a read and not everything that led to the rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def id_bucket(id_col: str, modulus: int = 5) -> Column:
    """``crc32(id as text) mod modulus``; a null id falls in bucket 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus, F.lit(0)).cast("int")


def word_count(text: Column) -> Column:
    """Words of a text as long; null and white text have none."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, WHITE_RE))).cast("long")


def raw_texts(column: pa.Array) -> list:
    """UTF-8 bytes (or None) of a string column, without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def extended(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in fields)])


def spare_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front while a column has that name (in any case)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def per_batch(df: DataFrame, text_col: str, fields: list[tuple[str, T.DataType]], make) -> DataFrame:
    """All rows and columns of ``df`` plus ``fields``, which ``make`` fills for a list of texts
    (bytes or None) at a time: it returns one sequence or Arrow array a field. No shuffle. A new
    column takes the place of one of that name (in any case) that ``df`` has."""
    new = {n.lower() for n, _ in fields}
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in new])
    at = df.columns.index(text_col)
    schema = extended(df.schema, *fields)
    kinds = [T_to_arrow(t) for _, t in fields]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                out = work(raw_texts(batch.column(at)))
                made = [x if isinstance(x, pa.Array) else pa.array(x, type=k) for x, k in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)

    return df.mapInArrow(run, schema)


def T_to_arrow(kind: T.DataType) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
            "string": pa.string(), "float": pa.float32(), "array<int>": pa.list_(pa.int32()),
            "array<float>": pa.list_(pa.float32()), "array<bigint>": pa.list_(pa.int64())}[kind.simpleString()] \
        if not isinstance(kind, (T.StructType,)) and not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)) \
        else _nested(kind)


def _nested(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_nested(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _nested(f.dataType)) for f in kind.fields])
    return T_to_arrow(kind)


class Numbers(dict):
    """Numbers keys as they are first asked for."""

    def __missing__(self, key: bytes) -> int:
        n = self[key] = len(self)
        return n


class WordIds:
    """Numbers the distinct words of a batch; ``words`` lists them in that order."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        ids = self.ids
        return np.fromiter([ids.setdefault(w, len(ids)) for w in words], np.int64, len(words))

    @property
    def words(self) -> list[bytes]:
        return list(self.ids)


def slabs(texts: list, most: int = 8_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of a batch with about ``most`` bytes each (one text at least), to bound memory."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def byte_grams(words: list[bytes], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte n-grams of ``^word$`` for all words at once: (gram bucket, word number).
    ``buckets`` is a power of two."""
    joined = np.frombuffer(b"".join(b"\x02%s\x03" % w for w in words), np.uint8).astype(np.uint64)
    lens = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lens)
    left = np.repeat(np.cumsum(lens), lens) - np.arange(len(joined))  # bytes up to the word's end
    grams, owners = [], []
    for n in sizes:
        if len(joined) < n:
            continue
        code = np.full(len(joined) - n + 1, n, np.uint64)
        for k in range(n):
            code = code * np.uint64(257) + joined[k : len(joined) - n + 1 + k]
        keep = left[: len(code)] >= n
        code = code[keep] * np.uint64(0x9E3779B97F4A7C15)
        grams.append((code >> np.uint64(64 - int(buckets).bit_length() + 1)).astype(np.int64))
        owners.append(owner[: len(keep)][keep])
    return (np.concatenate(grams), np.concatenate(owners)) if grams else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def sum_batches(rows: DataFrame, work, size: int) -> np.ndarray:
    """Sum over all rows of arrays of ``size`` numbers; ``work()`` gives a function from an Arrow
    batch to such an array. Each task adds up its own, then pieces of the sums are added on Spark."""
    step = 1 << 15

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        add = work()
        for batch in batches:
            if batch.num_rows:
                total += add(batch)
        for part in range(0, size, step):
            piece = total[part : part + step]
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([part // step]), pa.array([piece.tobytes()], pa.binary())], names=["part", "x"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[p] = sums.get(p, 0) + np.frombuffer(x)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["part", "x"])

    out = np.zeros(size)
    for r in rows.mapInArrow(run, "part long, x binary").repartition("part").mapInArrow(fold, "part long, x binary").toLocalIterator():
        x = np.frombuffer(r["x"])
        out[r["part"] * step : r["part"] * step + len(x)] += x
    return out


def sum_arrays(texts: DataFrame, work, size: int) -> np.ndarray:
    """``sum_batches`` over one column of texts, for a function from a list of texts to an array."""

    def of_batches():
        add = work()

        def batch_sum(batch: pa.RecordBatch) -> np.ndarray:
            found = raw_texts(batch.column(0))
            return sum((add(found[lo:hi]) for lo, hi in slabs(found)), np.zeros(size))

        return batch_sum

    return sum_batches(texts, of_batches, size)


def families(gram: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows of a matrix of likenesses by the nearest of ``most`` rows that are far from each other."""
    centres = [0]
    while len(centres) < min(most, len(gram)):
        centres.append(int(gram[:, centres].max(axis=1).argmin()))
    nearest = gram[:, centres].argmax(axis=1)
    return [x for x in (np.flatnonzero(nearest == k) for k in range(len(centres))) if len(x)]
