"""Shared helpers of the training-data operators: exact column picking, scratch tables, and words of Arrow batches in numpy.

The numpy helpers work on the concatenated UTF-8 bytes of a slice of an Arrow batch, so there is no Python loop per word.
Slices hold about ``CHUNK_BYTES`` of text, or one text if that is longer, which bounds a task's memory.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawmart.session import bytes_below, delete_at_exit, delete_path, scratch_path

CHUNK_BYTES = 1 << 19

_U = np.uint64
_B = 0x9E3779B97F4A7C55  # odd: has an inverse modulo 2**64
_C = 0xD6E8FEB86659FD95
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, by exact name and position: ``pick(docs, id="doc_id")`` has the one column ``id``.

    Extra columns whose names clash (also with other letter case) don't matter. A missing name raises ``ValueError``.
    """
    bound_batches(df.sparkSession)
    at = {alias: df.columns.index(name) for alias, name in names.items()}
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_c{i}").alias(alias) for alias, i in at.items()])


#: rows and bytes of the Arrow batches that tasks exchange with Python, whatever the length of texts
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20)}


def bound_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batch bounds to BATCH: memory of Python workers then doesn't depend on the lengths of texts."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)


def scratch(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back (lineage cut), in folders ``by`` columns.

    The shuffle files of finished steps are garbage; a collection on the driver lets Spark's cleaner drop them, so the steps'
    disk use doesn't add up.
    """
    spark = df.sparkSession
    path = delete_at_exit(spark, scratch_path(spark, f"materialized/llm-{name}/{uuid.uuid4().hex}"))
    (df.write.partitionBy(*by) if by else df.write).option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_folder = path
    spark.range(1).write.format("noop").mode("overwrite").save()  # the session holds on to the last job it ran
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def drop(table: DataFrame, part: str = "") -> None:
    """Delete a scratch table, or one of its folders (``column=value``), that nothing reads any more."""
    delete_path(table.sparkSession, f"{table.scratch_folder}/{part}".rstrip("/"))


#: bytes of a scratch table for each task that writes a table of about its rows or fewer, beyond one task for each core
TASK_BYTES = 4 << 20


def few_tasks(table: DataFrame) -> int:
    """Tasks that suffice to write tables not larger than this scratch table. Where a query has far more shuffle partitions, a file
    (and a task of each later read) for every partition costs more than the few rows in it."""
    spark = table.sparkSession
    return spark.sparkContext.defaultParallelism + bytes_below(spark, table.scratch_folder) // TASK_BYTES


def tidy(make: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """For generators that run in Python workers: at their end, memory that Arrow and the C library hold on to goes back to the
    machine. Workers live on idle from stage to stage, and would keep the most that any stage took."""

    @functools.wraps(make)
    def run(*args, **named):
        yield from make(*args, **named)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, so that every bit depends on all bits."""
    x = x ^ (x >> _U(30))
    x = x * _M1
    x = x ^ (x >> _U(27))
    x = x * _M2
    return x ^ (x >> _U(31))


_P = _U((1 << 61) - 1)  # prime: no strings collide whatever the base, as they do modulo a power of two
_LOW29, _LOW30, _LOW31, _LOW32 = (_U((1 << k) - 1) for k in (29, 30, 31, 32))
#: powers kept per process and base; longer runs compute theirs anew
POWERS = 1 << 17

_powers: dict[int, np.ndarray] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """Any 64-bit values modulo 2**61 - 1."""
    x = (x & _P) + (x >> _U(61))
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2**61 - 1 of values below it, from halves of 30 and 31 bits."""
    al, ah, bl, bh = a & _LOW31, a >> _U(31), b & _LOW31, b >> _U(31)
    mid = al * bh + ah * bl
    return _fold(((ah * bh) << _U(1)) + (mid >> _U(30)) + ((mid & _LOW30) << _U(31)) + al * bl)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**61 - 1; up to POWERS of them are kept."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, dtype=_U)
    while len(have) <= n:
        have = np.concatenate([have, times(have, _U(pow(base, len(have), int(_P))))])
        if len(have) <= POWERS:
            _powers[base] = have
    return have[: n + 1]


def window_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _B) -> np.ndarray:
    """Hash of values[s:e] for each pair, independent of its place: polynomials modulo 2**61 - 1 by prefix sums."""
    n = len(values)
    base %= int(_P)
    terms = times(_fold(mix(values.astype(_U, copy=False) + _U(1))), powers(base, n)[:n])
    low, high = np.zeros(n + 1, dtype=_U), np.zeros(n + 1, dtype=_U)  # two sums, so that none overflows
    np.cumsum(terms & _LOW32, out=low[1:])
    np.cumsum(terms >> _U(32), out=high[1:])
    top = _fold(high[ends] - high[starts])
    total = _fold(((top & _LOW29) << _U(32)) + (top >> _U(29)) + _fold(low[ends] - low[starts]))
    return mix(times(total, powers(pow(base, -1, int(_P)), n)[starts]) ^ mix((ends - starts).astype(_U)))


def run_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each run of bytes data[s:e] (words; runs don't overlap): a sum of random values by byte and place in the run."""
    size = ends - starts
    at = ranges(starts, size)
    place = (at - np.repeat(starts, size)).astype(_U)
    sums = np.zeros(len(at) + 1, dtype=_U)
    np.cumsum(mix((place << _U(8) | data[at].astype(_U)) + _U((seed * _C + _B) % (1 << 64))), out=sums[1:])
    last = np.cumsum(size)
    return mix((sums[last] - sums[last - size]) ^ mix(size.astype(_U) + _U(1)))


@dataclass
class Chunk:
    """Rows first..last of a batch: their bytes, and where each row's bytes start (``offsets[i]:offsets[i + 1]``)."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array; a null has no bytes."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    return (np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    data, offsets = utf8(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        yield Chunk(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


#: bytes of words ``[^\x20\x09-\x0D]+``
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` before A-Z are lower-cased
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Words:
    starts: np.ndarray  # byte places in the chunk
    ends: np.ndarray
    first: np.ndarray  # words of row i: first[i] .. first[i + 1]
    row: np.ndarray  # row of each word


def words(chunk: Chunk, table: np.ndarray = NOT_SPACE) -> Words:
    """Maximal runs of the table's bytes, never across rows."""
    inside = table[chunk.data]
    n = len(inside)
    begin, end = inside.copy(), inside.copy()
    if n:
        edge = np.zeros(n + 1, dtype=bool)
        edge[chunk.offsets] = True
        begin[1:] &= ~inside[:-1] | edge[1:n]
        end[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    first = np.searchsorted(starts, chunk.offsets)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return Words(starts, ends, first, row)


def word_hashes(chunk: Chunk, found: Words, lower: bool = False) -> np.ndarray:
    return run_hash(LOWER[chunk.data] if lower else chunk.data, found.starts, found.ends)


def gram_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first value of each run of ``k`` consecutive values inside a row, and each run's row."""
    counts = np.maximum(np.diff(first) - k + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return first[:-1][rows] + np.arange(len(rows)) - before[rows], rows


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] values), then those of starts[1], ..."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total)


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of bytes data[s:e] (none empty): one of each content, and which of these each run equals; found by hash, confirmed byte by byte."""
    size = ends - starts
    _, shown, which = np.unique(run_hash(data, starts, ends), return_index=True, return_inverse=True)
    other = size != size[shown[which]]
    other[~other] = _differ(data, starts[~other], starts[shown[which[~other]]], size[~other])
    alone = np.flatnonzero(other)  # their hash equals another run's: each stands for itself
    which[alone] = len(shown) + np.arange(len(alone))
    return np.append(shown, alone), which


def _differ(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[a:a + size] and data[b:b + size] differ (sizes above 0)."""
    if not len(size):
        return np.zeros(0, dtype=bool)
    return np.logical_or.reduceat(data[ranges(a, size)] != data[ranges(b, size)], np.cumsum(size) - size)


def list_array(values: pa.Array, counts: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a Spark DDL string, for the batches that a mapInArrow function returns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
