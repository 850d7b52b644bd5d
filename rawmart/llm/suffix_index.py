"""Exact byte-substring dedup with a logarithmic family of sparse suffix arrays.

Suffixes are sampled by content: of each ``length`` consecutive bytes, the place with the smallest hash of the PREFIX bytes from
there (the leftmost of equals). Equal strings of ``length`` bytes so have a sampled suffix at the same place, and about two
of ``length - PREFIX + 2`` suffixes are sampled. Each batch of texts gets its suffix array: its sampled suffixes in the order of
the fingerprint of their first PREFIX bytes, cut by fingerprint into buckets. A bucket's task scans each new array against
the levels of the index family it has, reports what both hold, and adds it as a level; levels of about equal size are merged,
so a suffix is merged a logarithmic number of times.

Matches are then extended around the suffixes that several texts share. The bytes from ``length - PREFIX`` before to
``length`` after such a suffix are its surroundings. Where all of a suffix's surroundings are equal, one comparison settles all
strings around it; only where they differ (at the edges of a match), the strings themselves are compared, those that a
ladder of short hashes to both sides doesn't rule out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import NO_ID, PLACES, PLACES_DDL, buckets_of, by_bucket, column, filled, gathered, keyed, merged_places, pack_windows, packed, parts, places, seen_before, settle_windows, starts_of_runs, text_classes, unpack
from .text import _B, arrow_schema, batch, chunks, drop, mix, ranges, scratch, tidy, window_hash

_U = np.uint64
#: long enough that few suffixes agree by chance: the shorter it is, the more texts of a large corpus share any prefix
PREFIX = 24
#: strings up to so many bytes are hashed by sums modulo 2**64
SHORT = 128
_SECOND = 0xC2B2AE3D27D4EB4F
EMPTY = hashlib.sha256(b"").hexdigest()
DONE, LATER, SHIPPED, REMOVED = 0, 1, 2, 3
WHOLE, EDGE = 0, 1
#: buckets over which the strings around one suffix are spread, so that a suffix of very many texts is no hot bucket
SPLIT = 4
#: bytes between the steps of a suffix's ladder: short hashes of how its surroundings go on to the left and to the right
STEP = 4


class NearHash:
    """Hashes of data[s:e]; up to SHORT bytes by sums modulo 2**64, which are fast and don't fail for strings so short."""

    def __init__(self, data: np.ndarray, base: int = _B):
        self.data, self.base = data, base
        self.sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum((data.astype(_U) + _U(1)) * _powers(base, len(data)), out=self.sums[1:])
        self.back = _powers(pow(base, -1, 1 << 64), len(data) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = ends - starts
        if len(size) and int(size.max()) > SHORT:
            return window_hash(self.data, starts, ends, self.base)
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + size.astype(_U))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[:1] = 1
    return np.cumprod(out, dtype=_U)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the PREFIX bytes from each place."""
    n = max(len(data) - PREFIX + 1, 0)
    near = NearHash(data)
    return mix((near.sums[PREFIX:] - near.sums[:n]) * near.back[:n] + _U(PREFIX)) if n else np.zeros(0, _U)


def least_ahead(h: np.ndarray, span: int) -> np.ndarray:
    """Smallest of the ``span`` hashes from each place."""
    least, reach = h, 1
    while reach * 2 <= span:
        least = np.minimum(least[: len(least) - reach], least[reach:])
        reach *= 2
    return np.minimum(least[: len(h) - span + 1], least[span - reach : len(h) - reach + 1]) if reach < span else least


def sampled(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sampled suffixes of the rows: places, rows and hashes."""
    h = prefix_hashes(data)
    span = length - PREFIX + 1
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    rows = np.flatnonzero(counts)
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    least = least_ahead(h, span)
    p = ranges(offsets[:-1][rows], counts[rows])
    now = least[p]
    # the sampled place moves where a row begins, the smallest hash changes, or the place itself falls behind
    moved = np.ones(len(p), dtype=bool)
    moved[1:] = (p[1:] != p[:-1] + 1) | (now[1:] != now[:-1]) | (h[p[:-1]] == now[:-1])
    p, now = p[moved], now[moved]
    step = (h[p[:, None] + np.arange(span)[None, :]] == now[:, None]).argmax(axis=1)
    at = np.unique(p + step)
    return at, np.searchsorted(offsets, at, "right") - 1, h[at]


class LevelFamily:
    """Suffix arrays of growing size. Each holds one entry for a fingerprint: its text, its place, and whether it was reported."""

    def __init__(self):
        self.levels: list[dict[str, np.ndarray]] = []

    def add(self, q: np.ndarray, owner: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scan a new array against all levels and add it. Returns texts and places of entries, old and new, found to be shared."""
        order = np.argsort(q)
        new = {"q": q[order], "owner": owner[order], "pos": pos[order], "told": np.zeros(len(q), dtype=bool)}
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for level in self.levels:
            at = np.minimum(np.searchsorted(level["q"], new["q"]), len(level["q"]) - 1)
            shared = (level["q"][at] == new["q"]) & (level["owner"][at] != new["owner"])
            new["told"] |= shared
            old = at[shared]
            old = old[~level["told"][old]]
            level["told"][old] = True
            out.append((level["owner"][old], level["pos"][old]))
        out.append((new["owner"][new["told"]], new["pos"][new["told"]]))
        if len(q):
            self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2]["q"]) < 2 * len(self.levels[-1]["q"]):
            b, a = self.levels.pop(), self.levels.pop()
            both = {k: np.concatenate([a[k], b[k]]) for k in a}
            order = np.argsort(both["q"], kind="stable")  # two sorted runs: a merge
            both = {k: v[order] for k, v in both.items()}
            heads = starts_of_runs(both["q"])
            told = np.logical_or.reduceat(both["told"], heads)
            self.levels.append({k: v[heads] for k, v in both.items()} | {"told": told})
        return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def _fingerprints(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """40 bits of a hash beside its bucket; equal fingerprints of different suffixes only cost a comparison later."""
    rest = h // _U(buckets)
    return rest.astype(np.uint32), (rest >> _U(32)).astype(np.uint8)


@tidy
def _arrays(batches: Iterator[pa.RecordBatch], schema: pa.Schema, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Suffix arrays of batches of texts, by bucket: of each hash one entry, or one report for each text if several of the batch have it."""

    def pieces(rows: pa.RecordBatch):
        c1 = rows.column("c1").to_numpy()
        for chunk in chunks(rows.column("text")):
            at, row, h = sampled(chunk.data, chunk.offsets, length)
            yield len(chunk.data), (h, c1[chunk.first : chunk.last][row], at - chunk.offsets[row])

    for kept in parts(batches, pieces):
        h, owner, pos = (np.concatenate(x) for x in zip(*kept, strict=True))
        order = np.argsort(h, kind="stable")
        h, owner, pos = h[order], owner[order], pos[order]
        heads = starts_of_runs(h)
        size = np.diff(np.append(heads, len(h)))
        other = owner != np.repeat(owner[heads], size)
        shared = np.repeat(np.logical_or.reduceat(other, heads), size) if len(heads) else other
        told, place, value = owner[shared], pos[shared], h[shared]
        order = np.lexsort((value, told))
        told, place, value = told[order], place[order], value[order]
        one = np.ones(len(told), dtype=bool)
        one[1:] = (told[1:] != told[:-1]) | (value[1:] != value[:-1])
        yield places(schema, buckets, told[one], place[one], kind=REMOVED)
        by_text = np.lexsort((pos[heads], owner[heads]))
        h, owner, pos = h[heads][by_text], owner[heads][by_text], pos[heads][by_text]
        low, high = _fingerprints(h, buckets)
        bucket_of = packed(schema, buckets, h, q=low, r=high, cs=owner, pos=pos.astype(np.int32))
        yield filled(bucket_of, schema, kind=SHIPPED, h=None)


def _scan(batches: Iterator[pa.RecordBatch], schema: pa.Schema, buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed places of shared entries; each bucket has an index family of its own."""

    def found():
        for rows in buckets_of(batches):
            family = LevelFamily()
            for row in rows:
                q = column([row], "q", np.uint32).astype(_U) | column([row], "r", np.uint8).astype(_U) << _U(32)
                order = np.argsort(q, kind="stable")
                one = order[starts_of_runs(q[order])]
                yield family.add(q[one], column([row], "cs", np.int64)[one], column([row], "pos", np.int32)[one])

    return merged_places(schema, buckets, found())


@tidy
def _surroundings(batches: Iterator[pa.RecordBatch], schema: pa.Schema, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Texts without a shared suffix are done; of the others, shared suffixes travel with a hash of their surroundings and the text is kept."""
    done: list[pa.RecordBatch] = []

    def pieces(rows: pa.RecordBatch):
        ids, c1, c2, hits = rows.column("id").to_numpy(), rows.column("c1").to_numpy(), rows.column("c2").to_numpy(), rows.column("pos").to_pylist()
        for chunk in chunks(rows.column("text")):
            here = slice(chunk.first, chunk.last)
            hit = [unpack(x) for x in hits[here]]
            mine = np.array([len(x) > 0 for x in hit], dtype=bool)
            data = chunk.data.tobytes()
            texts = [data[a:b] for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:], strict=True)]
            done.append(
                batch(
                    schema, kind=np.where(mine, LATER, DONE).astype(np.int32), c1=c1[here], c2=c2[here], n=np.diff(chunk.offsets),
                    sha=pa.array([None if m else hashlib.sha256(t).hexdigest() for m, t in zip(mine, texts, strict=True)], pa.string()),
                    text=pa.array([t if m else None for m, t in zip(mine, texts, strict=True)], pa.binary()),
                    **{c: pa.nulls(len(mine), schema.field(c).type) for c in ("bucket", "h", "x", "ids", "cs", "pos", "ladder")},
                )
            )
            of = np.flatnonzero(mine)
            own = np.frombuffer(b"".join(texts[i] for i in of), dtype=np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in of], dtype=np.int64)]).astype(np.int64)
            at, row, h = sampled(own, offsets, length)
            # all suffixes of a text with the hash of a shared one
            named = np.sort(np.concatenate([offsets[k] + hit[i] for k, i in enumerate(of)])) if len(of) else np.zeros(0, np.int64)
            place = np.searchsorted(at, named)
            tag = mix(h ^ mix(row.astype(_U) + _U(1)))
            shared = np.isin(tag, tag[place])
            at, row, h = at[shared], row[shared], h[shared]
            low, high = _around(at, offsets[row], offsets[row + 1], length)
            near = NearHash(own)
            x = near(low, high) ^ mix((at - low).astype(_U) + _U(1))
            who = of[row]
            yield len(own), (h, x, ids[here][who], c1[here][who], at - offsets[row], _ladder(near, at, low, high, length))

    for kept in parts(batches, pieces):
        yield from done
        done.clear()
        h, x, ids, cs, pos, ladder = (np.concatenate(y) for y in zip(*kept, strict=True))
        later = seen_before(h, x, ids)
        yield places(schema, buckets, cs[later], pos[later], kind=REMOVED)
        own = ~later
        yield filled(packed(schema, buckets, h[own], x=x[own], ids=ids[own], cs=cs[own], pos=pos[own].astype(np.int32), ladder=ladder[own]), schema, kind=SHIPPED)


def _around(at: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(at - (length - PREFIX), begin), np.minimum(at + length, end)


def _ladder(near: NearHash, at: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
    """16-bit hashes of the bytes up to each step to the left, then to the right; 0 where the surroundings end before."""
    out = []
    for step in range(STEP, length - PREFIX + 1, STEP):
        good = at - step >= low
        out.append(np.where(good, near(np.where(good, at - step, at), at) | _U(1), _U(0)).astype(np.uint16))
    for step in range(PREFIX + STEP, length + 1, STEP):
        good = at + step <= high
        out.append(np.where(good, near(at, np.where(good, at + step, at)) | _U(1), _U(0)).astype(np.uint16))
    return np.stack(out, axis=1)


def _reach(h: np.ndarray, x: np.ndarray, ladder: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes to the left, and to the right, of each suffix can at most equal those of one with other surroundings."""

    def shared(values: np.ndarray) -> np.ndarray:
        key = mix(h ^ mix(values.astype(_U) + _U(1)))
        order = np.argsort(key, kind="stable")
        heads = starts_of_runs(key[order])
        size = np.diff(np.append(heads, len(key)))
        other = x[order] != np.repeat(x[order][heads], size)
        out = np.zeros(len(key), dtype=bool)
        out[order] = np.repeat(np.logical_or.reduceat(other, heads), size) if len(heads) else other
        return out & (values > 0)

    lefts = list(range(STEP, length - PREFIX + 1, STEP))
    rights = list(range(PREFIX + STEP, length + 1, STEP))
    reach = []
    for steps, columns, most in ((lefts, ladder[:, : len(lefts)], length - PREFIX), (rights, ladder[:, len(lefts) :], length)):
        far = np.full(len(h), steps[0] - 1 if steps else most)
        on = np.ones(len(h), dtype=bool)
        for k in range(len(steps)):
            on &= shared(columns[:, k])
            far[on] = steps[k + 1] - 1 if k + 1 < len(steps) else most
        reach.append(far)
    return reach[0], reach[1]


def _compare(batches: Iterator[pa.RecordBatch], schema: pa.Schema, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Suffixes whose surroundings a smaller id has too are settled (WHOLE). Of the others, if the suffix has several
    surroundings, first and last start of the strings that others can share (EDGE, two places each)."""
    kept: dict[int, list] = {WHOLE: [], EDGE: []}

    def flush() -> Iterator[pa.RecordBatch]:
        for what, found in kept.items():
            yield from merged_places(schema, buckets, iter(found), what=what)
            found.clear()

    n = 0
    for rows in buckets_of(batches):
        h, x, ids = column(rows, "h", _U), column(rows, "x", _U), column(rows, "ids", np.int64)
        cs, pos = column(rows, "cs", np.int64), column(rows, "pos", np.int32)
        later = seen_before(h, x, ids)
        order = np.argsort(h, kind="stable")
        heads = starts_of_runs(h[order])
        size = np.diff(np.append(heads, len(h)))
        other = x[order] != np.repeat(x[order][heads], size)
        several = np.zeros(len(h), dtype=bool)
        several[order] = np.repeat(np.logical_or.reduceat(other, heads), size) if len(heads) else other
        kept[WHOLE].append((cs[later], pos[later]))
        several &= ~later
        ladder = column(rows, "ladder", np.uint16).reshape(len(h), -1)
        left, right = _reach(h[several], x[several], ladder[several], length)
        owner, at = cs[several], pos[several]
        edge = left + right >= length
        starts = np.stack([at - left, at - (length - right)], axis=1)[edge]
        kept[EDGE].append((np.repeat(owner[edge], 2), np.maximum(starts, 0).ravel().astype(np.int32)))
        n += len(h)
        if n >= PLACES:
            yield from flush()
            n = 0
    yield from flush()


@tidy
def _edges(batches: Iterator[pa.RecordBatch], schema: pa.Schema, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The strings of ``length`` bytes that edge suffixes leave to be compared."""

    def pieces(rows: pa.RecordBatch):
        ids, c1, found = rows.column("id").to_numpy(), rows.column("c1").to_numpy(), rows.column("pos").to_pylist()
        for chunk in chunks(rows.column("text")):
            mark = np.zeros(len(chunk.data) + 1, dtype=np.int32)
            for i, x in enumerate(found[chunk.first : chunk.last]):
                span = unpack(x).reshape(-1, 2).astype(np.int64)
                low, high = chunk.offsets[i] + span[:, 0], np.minimum(chunk.offsets[i] + span[:, 1], chunk.offsets[i + 1] - length)
                good = low <= high
                np.add.at(mark, low[good], 1)
                np.add.at(mark, high[good] + 1, -1)
            begin = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            of = np.searchsorted(chunk.offsets, begin, "right") - 1
            here = slice(chunk.first, chunk.last)
            # equal strings share their sampled suffix: dealt by its hash, a text's strings around one suffix stay together
            deal = least_ahead(prefix_hashes(chunk.data), length - PREFIX + 1)[begin] if len(begin) else np.zeros(0, _U)
            one, two = NearHash(chunk.data)(begin, begin + length), NearHash(chunk.data, _SECOND)(begin, begin + length)
            yield len(chunk.data), (one, two.astype(np.uint32), ids[here][of], c1[here][of], begin - chunk.offsets[of], deal + one % _U(SPLIT))

    for kept in parts(batches, pieces):
        yield from pack_windows(schema, buckets, (SHIPPED, REMOVED), *(np.concatenate(x) for x in zip(*kept, strict=True)))


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema, length: int) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        whole, single = rows.column("whole").to_pylist(), rows.column("single").to_pylist()
        for chunk in chunks(rows.column("text")):
            m = chunk.last - chunk.first
            mark = np.zeros(len(chunk.data) + 1, dtype=np.int32)
            for i in range(m):
                a, b = chunk.offsets[i], chunk.offsets[i + 1]
                at = a + unpack(single[chunk.first + i]).astype(np.int64)
                np.add.at(mark, at, 1)
                np.add.at(mark, at + length, -1)
                at = a + unpack(whole[chunk.first + i]).astype(np.int64)
                low, high = _around(at, a, b, length)
                np.add.at(mark, low, 1)
                np.add.at(mark, high, -1)
            gone = np.cumsum(mark[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            begins[chunk.offsets[:-1][np.diff(chunk.offsets) > 0]] = gone[chunk.offsets[:-1][np.diff(chunk.offsets) > 0]]
            below, runs = (np.concatenate([[0], np.cumsum(v)])[chunk.offsets] for v in (gone, begins))
            left = chunk.data[~gone].tobytes()
            cuts = chunk.offsets - below
            texts = [left[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield batch(
                schema, c1=rows.column("c1").slice(chunk.first, m), c2=rows.column("c2").slice(chunk.first, m), n=np.diff(chunk.offsets), removed=np.diff(below), spans=np.diff(runs),
                sha=pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()), kept=pa.array(texts, pa.binary()),
            )


def dedup_bytes(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept`` (binary) ``with_text``.

    Removed is each byte of a string of ``length`` bytes that also starts in a row with a smaller id; all strings are judged
    on the input, inside one row. A null text has no bytes. Rows with one id remove nothing from each other; a null id counts
    as greater than all others. Whole texts are compared; memory holds the hashes of PART_BYTES of text, of one bucket, or of
    the longest text. ``length`` is PREFIX or more.
    """
    if length < PREFIX:
        raise ValueError(f"length must be at least {PREFIX}")
    rows = keyed(docs, id_col, text_col)
    rows, keys, classes, buckets = text_classes(rows, "suffixes")

    ddl = "kind int, bucket int, h binary, q binary, r binary, cs binary, pos binary"
    schema = arrow_schema(ddl)
    arrays = scratch(rows.select("c1", "text").mapInArrow(lambda b: _arrays(b, schema, length, buckets), ddl), "suffix-arrays")
    hit_schema = arrow_schema(PLACES_DDL)
    hits = by_bucket(arrays.where(F.col("kind") == SHIPPED).select("bucket", "q", "r", "cs", "pos")).mapInArrow(lambda b: _scan(b, hit_schema, buckets), PLACES_DDL)
    hits = gathered(hits.unionByName(arrays.where(F.col("kind") == REMOVED).select("bucket", "cs", "pos")))
    chosen = scratch(classes.join(hits, "c1", "left"), "suffix-hits")
    drop(arrays)

    ddl2 = "kind int, c1 long, c2 long, n long, sha string, text binary, bucket int, h binary, x binary, ids binary, cs binary, pos binary, ladder binary"
    schema2 = arrow_schema(ddl2)
    first = rows.join(chosen, ["id", "c1", "c2"])  # the smallest row of each text
    state = scratch(first.mapInArrow(lambda b: _surroundings(b, schema2, length, buckets), ddl2), "surroundings", by=("kind",))
    what_ddl = f"what int, {PLACES_DDL}"
    what_schema = arrow_schema(what_ddl)
    shipped = by_bucket(state.where(F.col("kind") == SHIPPED).select("bucket", "h", "x", "ids", "cs", "pos", "ladder"))
    compared = scratch(shipped.mapInArrow(lambda b: _compare(b, what_schema, length, buckets), what_ddl), "compared", by=("what",))
    drop(state, f"kind={SHIPPED}")
    whole = compared.where(F.col("what") == WHOLE).select("bucket", "cs", "pos").unionByName(state.where(F.col("kind") == REMOVED).select("bucket", "cs", "pos"))

    later = state.where(F.col("kind") == LATER).select("c1", "c2", "text")
    edges = later.join(gathered(compared.where(F.col("what") == EDGE)), "c1").join(classes, ["c1", "c2"])
    ddl3 = "kind int, bucket int, h binary, g binary, ids binary, cs binary, pos binary"
    schema3 = arrow_schema(ddl3)
    strings = edges.select("id", "c1", "text", "pos").mapInArrow(lambda b: _edges(b, schema3, length, buckets), ddl3)
    single = scratch(gathered(settle_windows(strings, buckets, (SHIPPED, REMOVED))), "edge-removed")

    out_ddl = "c1 long, c2 long, n long, removed long, spans long, sha string, kept binary"
    out_schema = arrow_schema(out_ddl)
    cut = later.join(gathered(whole).withColumnRenamed("pos", "whole"), "c1", "left").join(single.withColumnRenamed("pos", "single"), "c1", "left")
    cut = cut.select("c1", "c2", "text", "whole", "single").mapInArrow(lambda b: _cut(b, out_schema, length), out_ddl)
    zero = F.lit(0).cast("long")
    done = state.where(F.col("kind") == DONE).select("c1", "c2", "n", zero.alias("removed"), zero.alias("spans"), "sha", F.lit(None).cast("binary").alias("kept"))
    results = done.unionByName(cut)
    if not with_text:
        results = results.drop("kept")
    results = results.dropDuplicates(["c1", "c2"])  # repeated rows
    out = keys.select("id", "c1", "c2").join(classes.withColumnRenamed("id", "least"), ["c1", "c2"]).join(results, ["c1", "c2"])
    copy = (F.col("id") > F.col("least")) & (F.col("n") >= length)  # all its strings stand in the smaller row
    return out.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        F.col("n").alias("n_bytes"),
        F.when(copy, F.col("n")).otherwise(F.col("removed")).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.col("spans")).alias("n_spans"),
        F.when(copy, EMPTY).otherwise(F.col("sha")).alias("kept_sha256"),
        *([F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if with_text else []),
    )
