"""Exact substring dedup of word windows with difference-cover anchors.

COVER is a perfect difference set modulo PERIOD: whatever two places a match of ``window`` words has in two texts, some shift
below PERIOD moves both to places that are in the cover modulo PERIOD. So it is enough to hash the ``window - PERIOD + 1``
words from each cover place (six places of 31): any long match shares such an aligned anchor. Only around anchors that
another text has too, the whole windows are then hashed (extended) and compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import NO_ID, PLACES_DDL, buckets_of, by_bucket, column, filled, gathered, keyed, merged_places, pack_windows, packed, parts, places, settle_windows, starts_of_runs, text_classes, unpack
from .text import arrow_schema, batch, chunks, drop, gram_starts, mix, scratch, tidy, window_hash, word_hashes, words

_U = np.uint64
#: every difference modulo 31 occurs between two of them
PERIOD, COVER = 31, (1, 2, 4, 9, 13, 19)
_SECOND = 0xC2B2AE3D27D4EB4F
EMPTY = hashlib.sha256(b"").hexdigest()

DONE, LATER, WINDOWS, REMOVED = 0, 1, 2, 3


def anchors(first: np.ndarray, value: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of texts of ``window`` words or more: place in ``value`` of each one's first word, and hash."""
    size = window - PERIOD + 1
    starts, rows = gram_starts(first, size)
    place = starts - first[rows]
    cover = np.zeros(PERIOD, dtype=bool)
    cover[list(COVER)] = True
    own = cover[place % PERIOD] & (np.diff(first)[rows] >= window)
    starts = starts[own]
    return starts, window_hash(value, starts, starts + size)


def joined_words(chunk, w, kept: np.ndarray) -> list[bytes]:
    """Of each row, the kept words joined by one space."""
    data = chunk.data.copy()
    take = np.zeros(len(data) + 1, dtype=np.int8)
    take[w.starts[kept]] += 1
    take[w.ends[kept]] -= 1
    take = np.cumsum(take[:-1]).astype(bool)
    own = np.flatnonzero(kept)
    between = own[:-1][w.row[own[:-1]] == w.row[own[1:]]]  # another kept word follows: white space stands behind this one
    data[w.ends[between]] = 0x20
    take[w.ends[between]] = True
    below = np.concatenate([[0], np.cumsum(take)])[chunk.offsets]
    out = data[take].tobytes()
    return [out[a:b] for a, b in zip(below[:-1], below[1:], strict=True)]


@tidy
def _find_anchors(batches: Iterator[pa.RecordBatch], schema: pa.Schema, window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed anchors: of each hash one entry for each text, or one in all if texts of this part share it (those are settled here)."""

    def pieces(rows: pa.RecordBatch):
        c1 = rows.column("c1").to_numpy()
        for chunk in chunks(rows.column("text")):
            w = words(chunk)
            starts, h = anchors(w.first, word_hashes(chunk, w), window)
            row = w.row[starts]
            yield len(chunk.data), (h, c1[chunk.first : chunk.last][row], starts - w.first[row])

    for kept in parts(batches, pieces):
        h, owner, pos = (np.concatenate(x) for x in zip(*kept, strict=True))
        order = np.lexsort((owner, h))
        h, owner, pos = h[order], owner[order], pos[order]
        one = np.ones(len(h), dtype=bool)
        one[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner, pos = h[one], owner[one], pos[one]
        heads = starts_of_runs(h)
        size = np.diff(np.append(heads, len(h)))
        shared = np.repeat(size > 1, size)
        yield places(schema, buckets, owner[shared], pos[shared], kind=REMOVED)
        travel = np.zeros(len(h), dtype=bool)
        travel[heads] = True
        by_text = np.lexsort((pos[travel], owner[travel]))
        out = packed(schema, buckets, h[travel][by_text], cs=owner[travel][by_text], pos=pos[travel][by_text].astype(np.int32))
        yield filled(out, schema, kind=WINDOWS)


def _shared_anchors(batches: Iterator[pa.RecordBatch], schema: pa.Schema, buckets: int) -> Iterator[pa.RecordBatch]:
    def found():
        for rows in buckets_of(batches):
            h, owner, pos = column(rows, "h", _U), column(rows, "cs", np.int64), column(rows, "pos", np.int32)
            order = np.argsort(h, kind="stable")
            heads = starts_of_runs(h[order])
            size = np.diff(np.append(heads, len(h)))
            # one text's entry occurs once in a part, and a part's texts are not in another part unless they are copies
            owners = owner[order]
            other = owners != np.repeat(owners[heads], size)
            shared = np.repeat(np.logical_or.reduceat(other, heads), size) if len(heads) else other
            yield owners[shared], pos[order][shared]

    return merged_places(schema, buckets, found())


@tidy
def _extend(batches: Iterator[pa.RecordBatch], schema: pa.Schema, window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Texts without a shared anchor are done; of the others, the windows around shared anchors travel and the text is kept."""
    done: list[pa.RecordBatch] = []

    def pieces(rows: pa.RecordBatch):
        ids, c1, c2, hits = rows.column("id").to_numpy(), rows.column("c1").to_numpy(), rows.column("c2").to_numpy(), rows.column("pos").to_pylist()
        for chunk in chunks(rows.column("text")):
            w = words(chunk)
            value = word_hashes(chunk, w)
            n = np.diff(w.first)
            here = slice(chunk.first, chunk.last)
            hit = [np.unique(unpack(x)) for x in hits[here]]
            mine = np.array([len(x) > 0 for x in hit], dtype=bool)
            texts = joined_words(chunk, w, np.ones(len(w.starts), dtype=bool))
            sha = [None if m else hashlib.sha256(t).hexdigest() for m, t in zip(mine, texts, strict=True)]
            done.append(
                batch(
                    schema, kind=np.where(mine, LATER, DONE).astype(np.int32), c1=c1[here], c2=c2[here], n=n.astype(np.int64), sha=pa.array(sha, pa.string()),
                    text=pa.array([t if m else None for m, t in zip(mine, texts, strict=True)], pa.binary()),
                    **{c: pa.nulls(len(n), schema.field(c).type) for c in ("bucket", "h", "g", "ids", "cs", "pos")},
                )
            )
            starts, h = anchors(w.first, value, window)
            # every anchor with the content of a shared one, also where a text repeats it
            row = w.row[starts]
            named = np.concatenate([w.first[i] + x for i, x in enumerate(hit)]) if mine.any() else np.zeros(0, np.int64)
            tag = mix(h ^ mix(row.astype(_U) + _U(1)))
            shared = np.isin(tag, tag[np.searchsorted(starts, named)])  # a chance equality only costs a comparison
            at, row = starts[shared], row[shared]
            low, high = np.maximum(at - PERIOD + 1, w.first[row]), np.minimum(at, w.first[row + 1] - window)
            mark = np.zeros(len(value) + 1, dtype=np.int32)
            np.add.at(mark, low, 1)
            np.add.at(mark, high + 1, -1)
            begin = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            of = w.row[begin]
            yield len(chunk.data), (window_hash(value, begin, begin + window), window_hash(value, begin, begin + window, _SECOND).astype(np.uint32), ids[here][of], c1[here][of], begin - w.first[of])

    for kept in parts(batches, pieces):
        yield from done
        done.clear()
        yield from pack_windows(schema, buckets, (WINDOWS, REMOVED), *(np.concatenate(x) for x in zip(*kept, strict=True)))


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema, window: int) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        places_ = rows.column("pos").to_pylist()
        for chunk in chunks(rows.column("text")):
            w = words(chunk)
            mark = np.zeros(len(w.starts) + 1, dtype=np.int32)
            for i, x in enumerate(places_[chunk.first : chunk.last]):
                at = w.first[i] + unpack(x)
                np.add.at(mark, at, 1)
                np.add.at(mark, at + window, -1)
            gone = np.cumsum(mark[:-1]) > 0
            texts = joined_words(chunk, w, ~gone)
            m = chunk.last - chunk.first
            yield batch(
                schema, c1=rows.column("c1").slice(chunk.first, m), c2=rows.column("c2").slice(chunk.first, m), n=np.diff(w.first).astype(np.int64),
                removed=np.bincount(w.row[gone], minlength=m).astype(np.int64), sha=pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()), kept=pa.array([t.decode() for t in texts], pa.string()),
            )


def dedup_windows(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Row for each row of ``docs``: doc_id, n_words, n_removed, kept_sha256, and ``kept`` (the kept words joined by one space) ``with_text``.

    Removed is each word (words between white space) inside a window of ``window`` words that also starts in a row with a
    smaller id; all windows are judged on the input. A null text has no words. Rows with one id don't remove words from each
    other; a null id counts as greater than all others. Whole texts are compared; memory holds the hashes of PART_BYTES of
    text, of one bucket, or of the longest text. ``window`` is PERIOD or more.
    """
    if window < PERIOD:
        raise ValueError(f"window must be at least {PERIOD}")
    rows = keyed(docs, id_col, text_col)
    rows, keys, classes, buckets = text_classes(rows, "windows")

    ddl = "kind int, bucket int, h binary, cs binary, pos binary"
    schema = arrow_schema(ddl)
    found = scratch(rows.select("c1", "text").mapInArrow(lambda b: _find_anchors(b, schema, window, buckets), ddl), "anchors")
    hit_schema = arrow_schema(PLACES_DDL)
    hits = by_bucket(found.where(F.col("kind") == WINDOWS).select("bucket", "h", "cs", "pos")).mapInArrow(lambda b: _shared_anchors(b, hit_schema, buckets), PLACES_DDL)
    hits = gathered(hits.unionByName(found.where(F.col("kind") == REMOVED).select("bucket", "cs", "pos")))
    chosen = scratch(classes.join(hits, "c1", "left"), "anchor-hits")
    drop(found)

    ddl2 = "kind int, c1 long, c2 long, n long, sha string, text binary, bucket int, h binary, g binary, ids binary, cs binary, pos binary"
    schema2 = arrow_schema(ddl2)
    first = rows.join(chosen, ["id", "c1", "c2"])  # the smallest row of each text
    state = scratch(first.mapInArrow(lambda b: _extend(b, schema2, window, buckets), ddl2), "windows", by=("kind",))
    moved = state.where(F.col("kind").isin(WINDOWS, REMOVED))
    removed = scratch(gathered(settle_windows(moved, buckets, (WINDOWS, REMOVED))), "removed-windows")
    drop(state, f"kind={WINDOWS}")
    out_ddl = "c1 long, c2 long, n long, removed long, sha string, kept string"
    out_schema = arrow_schema(out_ddl)
    later = state.where(F.col("kind") == LATER).select("c1", "c2", "text").join(removed, "c1", "left")
    cut = later.mapInArrow(lambda b: _cut(b, out_schema, window), out_ddl)
    done = state.where(F.col("kind") == DONE).select("c1", "c2", "n", F.lit(0).cast("long").alias("removed"), "sha", F.lit(None).cast("string").alias("kept"))
    results = done.unionByName(cut).dropDuplicates(["c1", "c2"])  # repeated rows
    if not with_text:
        results = results.drop("kept")
    out = keys.select("id", "c1", "c2").join(classes.withColumnRenamed("id", "least"), ["c1", "c2"]).join(results, ["c1", "c2"])
    copy = (F.col("id") > F.col("least")) & (F.col("n") >= window)  # all its windows stand in the smaller row
    return out.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.col("removed")).alias("n_removed"),
        F.when(copy, EMPTY).otherwise(F.col("sha")).alias("kept_sha256"),
        *([F.when(copy, "").otherwise(F.col("kept")).alias("kept")] if with_text else []),
    )
