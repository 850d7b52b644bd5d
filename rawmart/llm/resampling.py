"""Target-distribution importance resampling with hashed word features.

Features (runs of consecutive words) are counted by the CRC-32 of their bytes in a fixed number of buckets, for the documents
and for the target. The CRCs are made for a whole batch at once: a feature's distinct contents are grouped by equal length
into matrices of bytes, one row each, and all CRCs of a matrix step together, column by column.

A document's weight is the mean over its features of how much likelier their buckets are in the target. The draw adds a Gumbel
variate from a hash of the id to it and takes the highest sums, which draws without replacement in proportion to exp(weight).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .text import ALNUM, LOWER, Words, arrow_schema, batch, chunks, distinct, gram_starts, pick, ranges, scratch, tidy, words

#: CRC-32 table, made from its polynomial
_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _TABLE = np.where(_TABLE & 1, (_TABLE >> 1) ^ np.uint32(0xEDB88320), _TABLE >> 1).astype(np.uint32)
#: a matrix has at least one row for so many columns; the few contents of a rare great length take their CRCs one by one
COLUMNS_PER_ROW = 64


def crc32s(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of each data[s:e], by matrices of equal lengths."""
    size = ends - starts
    out = np.zeros(len(size), dtype=np.uint32)
    if not len(size):
        return out
    order = np.argsort(size, kind="stable")
    lengths, heads = np.unique(size[order], return_index=True)
    for length, first, last in zip(lengths.tolist(), heads, [*heads[1:], len(order)], strict=True):
        rows = order[first:last]
        if length > COLUMNS_PER_ROW * len(rows):
            out[rows] = [zlib.crc32(data[a : a + length].tobytes()) for a in starts[rows].tolist()]
            continue
        crc = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
        matrix = data[starts[rows][:, None] + np.arange(length)[None, :]]
        for column in matrix.T:
            crc = _TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        out[rows] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def _joined(chunk) -> tuple[np.ndarray, Words]:
    """The lower-cased words of a chunk, with one space after each, and their places."""
    w = words(chunk, ALNUM)
    size = w.ends - w.starts
    ends = np.cumsum(size + 1) - 1
    data = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, dtype=np.uint8)
    data[ranges(ends - size, size)] = LOWER[chunk.data[ranges(w.starts, size)]]
    return data, Words(ends - size, ends, w.first, w.row)


def features(chunk, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of a chunk's distinct features, which of them each feature is, each feature's row, and words by row."""
    data, w = _joined(chunk)
    starts, ends, rows = [], [], []
    for k in range(1, most + 1):
        first, row = gram_starts(w.first, k)
        starts.append(w.starts[first])
        ends.append(w.ends[first + k - 1])
        rows.append(row)
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    shown, which = distinct(data, starts, ends)
    return (crc32s(data, starts[shown], ends[shown]) % np.uint32(buckets)).astype(np.int64), which, np.concatenate(rows), np.diff(w.first)


@tidy
def _count(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, dtype=np.int64)
    for rows in batches:
        for chunk in chunks(rows.column("text")):
            bucket, which, _, _ = features(chunk, most, buckets)
            total += np.bincount(bucket, weights=np.bincount(which, minlength=len(bucket)), minlength=buckets).astype(np.int64)
    used = np.flatnonzero(total)
    yield batch(schema, bucket=used.astype(np.int32), n=total[used])


def bucket_counts(rows: DataFrame, most: int, buckets: int, text_col: str = "text") -> np.ndarray:
    """Features of all texts by bucket, on the driver: ``buckets`` numbers, however large the table is."""
    ddl = "bucket int, n long"
    schema = arrow_schema(ddl)
    found = pick(rows, text=text_col).where("text is not null").mapInArrow(lambda b: _count(b, schema, most, buckets), ddl)
    found = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1)(S + B) / ((s + 1)(T + B)))) for each of the B buckets."""
    b = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


@tidy
def _weigh(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most: int, gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for chunk in chunks(rows.column("text")):
            bucket, which, row, n_words = features(chunk, most, len(gains))
            order = np.argsort(row, kind="stable")  # the features of a row one after another
            sums = np.concatenate([[0], np.cumsum(gains[bucket][which[order]])])
            n = np.bincount(row, minlength=len(n_words))
            last = np.cumsum(n)
            weight = (sums[last] - sums[last - n]) // np.maximum(n, 1)
            yield batch(schema, id=rows.column("id").slice(chunk.first, len(n)), n_features=n.astype(np.int64), n_words=n_words.astype(np.int64), weight=weight)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    min_words: int = 20,
    most: int = 1,
    buckets: int = 10000,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """Row for each row of ``docs``: doc_id, n_features, n_words, weight, score, rank (1 is the highest score; null if not drawn).

    Words are runs of letters and digits, A-Z lower-cased; features are all runs of 1 to ``most`` of them, repeats counted.
    ``percent`` of the rows with ``min_words`` words or more are drawn (rounded down), ties to the smaller id. A null text, or
    one without words, has no features and weight 0. Null ids count as one key, after all others in a tie; rows of one id draw
    the same variate. An empty target, or corpus, has no features in any bucket; no rows give no rows. Whole texts are read;
    memory holds the features of CHUNK_BYTES of text, or of the longest text, and a number for each bucket.
    """
    gains = bucket_gains(bucket_counts(docs, most, buckets, text_col), bucket_counts(target, most, buckets, target_text_col))
    rows = pick(docs, id=id_col, text=text_col)
    ddl = f"id {rows.schema['id'].dataType.simpleString()}, n_features long, n_words long, weight long"
    schema = arrow_schema(ddl)
    weighed = rows.mapInArrow(lambda b: _weigh(b, schema, most, gains), ddl)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = scratch(weighed.withColumn("score", F.col("weight") + gumbel), "resampling-scores")

    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    # a range sort: equal scores, however many, are dealt to tasks by id; a row's rank is its place in its task and those before
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), "n_features", "weight"]
    placed = scored.where(able).orderBy(*order).withColumns({"task": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    placed = scratch(placed, "resampling-order")
    tasks = placed.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))  # a row for each task
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("task", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = placed.join(tasks, "task").withColumn("rank", (F.col("before") + F.col("at") - F.col("low") + 1).cast("long"))
    columns = [F.col("id").alias("doc_id"), "n_features", "n_words", "weight", "score"]
    out = ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return out.unionByName(scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


def sample(docs: DataFrame, drawn: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, whole, whose id was drawn."""
    ids = drawn.where("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    names = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    return flat.join(ids, flat[f"_c{names.index(id_col)}"].eqNullSafe(ids["_drawn"]), "left_semi").toDF(*names)
