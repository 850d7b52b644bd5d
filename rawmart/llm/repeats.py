"""Exchange of hashes by bucket, shared by the two exact substring operators.

Hashes travel in packed rows: a row holds, for one bucket (a share of the hash values), the entries of one part of the input as
binary columns. What a part can settle by itself it settles before the shuffle: a hash that its own texts share travels once,
however many of them there are, so a passage in a third of all texts is no hot bucket. The number of buckets is in proportion
to the input, so a bucket's entries stay bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import arrow_schema, batch, pick, scratch, tidy

_U = np.uint64
#: text bytes for each bucket
BUCKET_BYTES = 4 << 20
#: text bytes whose hashes a task packs at a time
PART_BYTES = 16 << 20
#: stands in for a null id, which so counts as greater than all others
NO_ID = (1 << 63) - 1


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows id, c1, c2, text: a null text as the empty one, c1 and c2 together the text's 128-bit hash."""
    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.select(F.coalesce("id", F.lit(NO_ID).cast("long")).alias("id"), F.xxhash64("text").alias("c1"), F.xxhash64(F.lit("second"), "text").alias("c2"), "text")


def text_classes(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """``rows``, keys of all rows (id, c1, c2), the smallest id of each text (c1, c2, id), and the number of buckets for this input.

    After it, c1 alone tells texts apart, so it can stand for its text in packed rows: the few texts that share c1 but not c2
    (about n * n / 2**65 pairs of n texts) get another c1, from both hashes.
    """
    keys = scratch(rows.select("id", "c1", "c2", F.octet_length("text").cast("long").alias("bytes")), f"{name}-keys")
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    classes = scratch(keys.groupBy("c1", "c2").agg(F.min("id").alias("id")), f"{name}-classes")
    while True:
        twins = classes.groupBy("c1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c1")
        if twins.isEmpty():
            return rows, keys, classes, int(total // BUCKET_BYTES) + 1
        names = F.broadcast(scratch(classes.join(twins, "c1").select("c1", "c2", F.xxhash64(F.lit("twin"), "c1", "c2").alias("name")), f"{name}-twins"))
        rows, keys, classes = (x.join(names, ["c1", "c2"], "left").withColumn("c1", F.coalesce("name", "c1")).drop("name") for x in (rows, keys, classes))


def starts_of_runs(sorted_values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else np.zeros(0, np.int64)


def packed(schema: pa.Schema, buckets: int, h: np.ndarray, deal: np.ndarray | None = None, **columns: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket: its entries' hashes and other columns as binaries, in the order given. Buckets are dealt by h, or by ``deal``."""
    bucket = ((h if deal is None else deal) % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    heads = starts_of_runs(bucket[order])
    ends = np.append(heads[1:], len(order))

    def binary(values: np.ndarray) -> pa.Array:
        values = np.ascontiguousarray(values[order])
        width = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
        offsets = np.concatenate([[0], ends * width]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets), pa.py_buffer(values.reshape(-1))])

    got = {"bucket": bucket[order][heads].astype(np.int32), "h": binary(h)} | {c: binary(v) for c, v in columns.items()}
    return batch(schema, **{f.name: got[f.name] if f.name in got else pa.nulls(len(heads), f.type) for f in schema})


def by_bucket(rows: DataFrame) -> DataFrame:
    """Packed rows dealt by bucket, those of a bucket one after another."""
    return rows.repartition("bucket").sortWithinPartitions("bucket")


def buckets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The packed rows of one bucket at a time."""
    now, rows = None, []
    for part in batches:
        for row in part.to_pylist():
            if row["bucket"] != now and rows:
                yield rows
                rows = []
            now = row["bucket"]
            rows.append(row)
    if rows:
        yield rows


def column(rows: list[dict], name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows), dtype=dtype)


def filled(rows: pa.RecordBatch, schema: pa.Schema, **values: int | None) -> pa.RecordBatch:
    """``rows`` with one value in all of a column."""
    for c, value in values.items():
        rows = rows.set_column(schema.get_field_index(c), schema.field(c), pa.array([value] * rows.num_rows, schema.field(c).type))
    return rows


#: columns of packed places
PLACES_DDL = "bucket int, cs binary, pos binary"


def places(schema: pa.Schema, buckets: int, owner: np.ndarray, pos: np.ndarray, **fixed: int | None) -> pa.RecordBatch:
    """Packed places: a row for each bucket of owners (texts), with its entries' owners (cs) and places (pos, int32).

    A row for each owner would make texts times buckets rows of the places that are found bucket by bucket, since a text's
    places lie in many of them.
    """
    order = np.argsort(owner, kind="stable")
    owner, pos = owner[order], pos[order].astype(np.int32)
    if "h" in schema.names:
        fixed["h"] = None
    return filled(packed(schema, buckets, owner.astype(_U), cs=owner, pos=pos), schema, **fixed)


#: entries whose places are gathered before they are sent on
PLACES = 2_000_000


def merged_places(schema: pa.Schema, buckets: int, found: Iterator[tuple[np.ndarray, np.ndarray]], **fixed) -> Iterator[pa.RecordBatch]:
    """Packed places of many buckets together: rows number with the tasks (and each PLACES entries), not with the buckets scanned."""
    kept, n = [], 0
    for owner, pos in found:
        if len(owner):
            kept.append((owner, pos))
            n += len(owner)
        if n >= PLACES:
            yield places(schema, buckets, *(np.concatenate(x) for x in zip(*kept, strict=True)), **fixed)
            kept, n = [], 0
    if kept:
        yield places(schema, buckets, *(np.concatenate(x) for x in zip(*kept, strict=True)), **fixed)


@tidy
def _by_text(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for rows in buckets_of(batches):
        owner, pos = column(rows, "cs", np.int64), column(rows, "pos", np.int32)
        order = np.argsort(owner, kind="stable")
        owner, pos = owner[order], pos[order]
        heads = starts_of_runs(owner)
        offsets = np.concatenate([[0], np.append(heads[1:], len(owner)) * 4]).astype(np.int32)
        yield batch(schema, c1=owner[heads], pos=pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets), pa.py_buffer(pos)]))


def gathered(rows: DataFrame) -> DataFrame:
    """All places of each text of packed places: c1, pos (binary of int32, those of one row in their order; bounded by the text's length)."""
    ddl = "c1 long, pos binary"
    schema = arrow_schema(ddl)
    return by_bucket(rows.select("bucket", "cs", "pos")).mapInArrow(lambda b: _by_text(b, schema), ddl)


def unpack(value: bytes | None) -> np.ndarray:
    return np.frombuffer(value or b"", dtype=np.int32)


def seen_before(h: np.ndarray, g: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of entries with hashes (h, g): whether the same hashes occur with a smaller id."""
    order = np.lexsort((ids, g, h))
    h, g, sorted_ids = h[order], g[order], ids[order]
    head = np.ones(len(h), dtype=bool)
    head[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    heads = np.flatnonzero(head)
    least = np.repeat(sorted_ids[heads], np.diff(np.append(heads, len(h))))
    out = np.zeros(len(h), dtype=bool)
    out[order] = sorted_ids > least
    return out


def settle_windows(windows: DataFrame, buckets: int, kinds: tuple[int, int]) -> DataFrame:
    """Packed windows (kinds[0]: bucket, h, g, ids, cs, pos) -> packed places of those whose content also occurs with a smaller id.

    Rows of kinds[1] (packed places) were settled before and pass through.
    """
    schema = arrow_schema(PLACES_DDL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled: list[pa.RecordBatch] = []

        def open_() -> Iterator[pa.RecordBatch]:
            for part in batches:
                kind = part.column("kind").to_numpy()
                settled.append(part.filter(pa.array(kind == kinds[1])))
                yield part.filter(pa.array(kind == kinds[0]))

        def found():
            for rows in buckets_of(open_()):
                later = seen_before(column(rows, "h", _U), column(rows, "g", np.uint32), column(rows, "ids", np.int64))
                yield column(rows, "cs", np.int64)[later], column(rows, "pos", np.int32)[later]

        def passed() -> Iterator[pa.RecordBatch]:
            for part in settled:
                yield part.select(schema.names)
            settled.clear()

        for out in merged_places(schema, buckets, found()):
            yield from passed()
            yield out
        yield from passed()

    return by_bucket(windows.select("kind", "bucket", "h", "g", "ids", "cs", "pos")).mapInArrow(run, PLACES_DDL)


def pack_windows(schema: pa.Schema, buckets: int, kinds: tuple[int, int], h, g, ids, cs, pos, deal=None) -> Iterator[pa.RecordBatch]:
    """Windows of one part: those with a smaller id in the part are settled here (kinds[1]), those of the smallest id travel (kinds[0]).

    ``deal`` follows from a window's content; windows of equal ``deal`` go to one bucket.
    """
    later = seen_before(h, g, ids)
    yield places(schema, buckets, cs[later], pos[later], kind=kinds[1])
    own = ~later
    out = packed(schema, buckets, h[own], None if deal is None else deal[own], g=g[own].astype(np.uint32), ids=ids[own], cs=cs[own], pos=pos[own].astype(np.int32))
    yield filled(out, schema, kind=kinds[0])


def parts(batches: Iterator[pa.RecordBatch], pieces: Callable[[pa.RecordBatch], Iterator[tuple[int, tuple]]]) -> Iterator[list[tuple]]:
    """Results of ``pieces`` (bytes, arrays), gathered up to PART_BYTES."""
    kept, n = [], 0
    for rows in batches:
        for size, arrays in pieces(rows):
            kept.append(arrays)
            n += size
            if n >= PART_BYTES:
                yield kept
                kept, n = [], 0
    if kept:
        yield kept
