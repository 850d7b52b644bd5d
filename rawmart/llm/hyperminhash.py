"""Near-duplicates by HyperMinHash.

A document's set of word shingles is hashed into REGISTERS buckets. A register compresses its bucket's smallest hash to the
number of leading zeros and the MANTISSA bits after them, 16 bits in all. Registers are banded: documents that agree in all
registers of a band are candidates. Registers of empty buckets borrow from a full one for banding (by fixed priorities, so
that two sets borrow alike), which keeps bands of short documents as selective as those of long ones. Candidates pass three
tests: sizes, the low bits of the banding registers, and the Jaccard estimate from the registers, corrected for collisions
of compressed values, each with a margin of MARGIN standard deviations. What is left is confirmed on the full sets.

No group is expanded into all its pairs. Documents with equal sets are one class. In each bucket of equal bands, every class
is first tried against the bucket's smallest one, and what the bucket's classes have in common beyond that is reported as
a spanning forest: candidates, direct or by way of others, form a family. Confirmed links with the smallest classes give
components; families that still have several of them are compared in pairs of blocks of bounded size, where only links
that connect two components are confirmed and reported.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, joined, thinned
from .text import arrow_schema, batch, chunks, few_tasks, gram_starts, list_array, pick, scratch, tidy, window_hash, word_hashes, words

_U = np.uint64
REGISTER_BITS = 8
REGISTERS = 1 << REGISTER_BITS
MANTISSA = 10
#: bands of so many registers; at a similarity of 0.8 a pair shares none with a chance of 2e-9, at 0.85 of 1e-13
BAND = 5
BANDS = REGISTERS // BAND
MARGIN = 6
#: rows of a bucket, and of a family, that meet as one side of a comparison
BUCKET_BLOCK, FAMILY_BLOCK = 1024, 128
#: pairs of a family whose registers are compared at once
PAIRS = 4096

_priority = np.random.default_rng(20240613).permuted(np.tile(np.arange(REGISTERS, dtype=np.int16), (REGISTERS, 1)), axis=1)


def shingle_sets(chunk, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row: of k words, or of the whole sequence if it has fewer."""
    w = words(chunk)
    value = word_hashes(chunk, w, lower=True)
    counts = np.diff(w.first)
    starts, _ = gram_starts(w.first, k)
    full = window_hash(value, starts, starts + k)
    cut = np.concatenate([[0], np.cumsum(np.maximum(counts - k + 1, 0))])
    out = []
    for i, n in enumerate(counts):
        if n >= k:
            s = np.sort(full[cut[i] : cut[i + 1]])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif n:
            out.append(window_hash(value, w.first[i : i + 1], w.first[i + 1 : i + 2]))
        else:
            out.append(np.zeros(0, _U))
    return out


def registers(hashes: np.ndarray) -> np.ndarray:
    """Compressed minima of sorted hashes: leading zeros plus 1, then MANTISSA bits; 0 for an empty bucket."""
    out = np.zeros(REGISTERS, dtype=np.uint16)
    bucket = (hashes >> _U(64 - REGISTER_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = ((hashes[first] & _U((1 << (64 - REGISTER_BITS)) - 1)) >> _U(64 - REGISTER_BITS - 53)).astype(np.float64)  # 53 bits: exact
    fraction, exponent = np.frexp(rest)
    zeros = np.where(rest > 0, 53 - exponent, 53)
    mantissa = np.floor((fraction * 2 - 1) * (1 << MANTISSA))
    out[bucket[first]] = ((zeros + 1).astype(np.uint16) << MANTISSA) + np.where(rest > 0, mantissa, 0).astype(np.uint16)
    return out


def borrowed(regs: np.ndarray) -> np.ndarray:
    """Registers with each empty one filled from the full one of its highest priority."""
    full = regs > 0
    if full.all() or not full.any():
        return regs
    empty, have = np.flatnonzero(~full), np.flatnonzero(full)
    out = regs.copy()
    out[empty] = regs[have[_priority[np.ix_(empty, have)].argmax(axis=1)]]
    return out


def chance_equal(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that two unrelated minima of buckets with n and m hashes compress to the same value.

    The minima are exponential with rates n and m; a cell with z leading zeros is 2**-(z + 1 + MANTISSA) wide, and the chance
    that both fall into one cell is its width times the integral of the product of their densities.
    """
    total = np.zeros(np.broadcast(n, m).shape)
    for z in range(54):
        low, high = 2.0 ** -(z + 1), 2.0**-z
        total += 2.0 ** -(z + 1 + MANTISSA) * n * m / (n + m) * (np.exp(-(n + m) * low) - np.exp(-(n + m) * high))
    return np.minimum(total, 0.5)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of register rows a and b of sets of n and m shingles, and the registers it rests on."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    chance = chance_equal(n / REGISTERS, m / REGISTERS)
    return np.clip((same / np.maximum(used, 1) - chance) / (1 - chance), 0, 1), used


def most_differ(full, similarity: float):
    """Most low bits in which banding registers of linked sets differ, MARGIN standard deviations above their mean.

    ``full`` (an array or a Spark column) is the number of registers that are not empty, the smaller one of both sets. Each of
    them also stands in the empty ones that borrowed it, so the fewer there are, the more bits differ at once: a full register
    is seen once and (REGISTERS - full) / full times more, and its share of the variance is the mean square of that.
    """
    half = (1 - similarity) / 2
    return half * REGISTERS + MARGIN * (half * (1 - half) * (REGISTERS * REGISTERS / full + REGISTERS - full)) ** 0.5


@tidy
def _sketch(batches: Iterator[pa.RecordBatch], schema: pa.Schema, k: int) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for chunk in chunks(rows.column("text")):
            sets = shingle_sets(chunk, k)
            digests = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), dtype=np.int64).reshape(-1, 2)
            yield batch(
                schema, id=rows.column("id").slice(chunk.first, chunk.last - chunk.first), n=np.array([len(s) for s in sets], np.int64), a=digests[:, 0], b=digests[:, 1],
                registers=pa.array([registers(s).tobytes() for s in sets], pa.binary()),
            )


@tidy
def _band(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(0, whole.num_rows, 2048):
            rows = whole.slice(i, 2048)
            own = [np.frombuffer(x, np.uint16) for x in rows.column("registers").to_pylist()]
            full = np.array([np.count_nonzero(x) for x in own], np.int32)
            regs = np.stack([borrowed(x) for x in own])
            n = len(regs)
            bands = regs[:, : BAND * BANDS].astype(_U).reshape(n * BANDS, BAND)
            bands = np.concatenate([bands, np.tile(np.arange(BANDS, dtype=_U), n)[:, None]], axis=1).ravel()
            starts = np.arange(n * BANDS) * (BAND + 1)
            keys = window_hash(bands, starts, starts + BAND + 1)
            low = np.packbits((regs & 1).astype(np.uint8), axis=1).view(np.int64)
            lists = {"keys": list_array(pa.array(keys.view(np.int64)), np.full(n, BANDS)), "low": list_array(pa.array(low.ravel()), np.full(n, low.shape[1]))}
            yield batch(schema, id=rows.column("id"), n=rows.column("n"), full=full, **{c: x.cast(schema.field(c).type) for c, x in lists.items()})


def _estimated(batches: Iterator[pa.RecordBatch], schema: pa.Schema, similarity: float) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        side = lambda c: np.stack([np.frombuffer(x, np.uint16) for x in rows.column(c).to_pylist()])  # noqa: B023, E731
        if rows.num_rows:
            value, used = estimate(side("rx"), side("ry"), rows.column("nx").to_numpy(), rows.column("ny").to_numpy())
            good = value >= similarity - MARGIN * np.sqrt(similarity * (1 - similarity) / np.maximum(used, 1))
            yield rows.filter(pa.array(good)).select(schema.names)


@tidy
def _confirmed(batches: Iterator[pa.RecordBatch], schema: pa.Schema, k: int, percent: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(0, whole.num_rows, 256):
            rows = whole.slice(i, 256)
            sides = []
            for c in ("tx", "ty"):
                sides.append([s for chunk in chunks(rows.column(c)) for s in shingle_sets(chunk, k)])
            good = []
            for s, t in zip(*sides, strict=True):
                common = len(np.intersect1d(s, t, assume_unique=True))
                good.append(100 * common >= percent * (len(s) + len(t) - common) and common > 0)
            yield rows.filter(pa.array(good)).select(schema.names)


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows that come sorted by the keys, as tables that end where a group ends."""
    rest: pa.Table | None = None
    for rows in batches:
        table = pa.Table.from_batches([rows])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not table.num_rows:
            continue
        key = np.stack([table.column(c).to_numpy() for c in keys], axis=1)
        other = (key != key[-1]).any(axis=1)
        last = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if last:
            yield table.slice(0, last).combine_chunks()
        rest = table.slice(last).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


class Union:
    """Union-find over a few values."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (p := self.parent.setdefault(x, x)) != x:
            self.parent[x] = self.parent[p]
            x = p
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether a and b were apart."""
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _forests(batches: Iterator[pa.RecordBatch], schema: pa.Schema, percent: int) -> Iterator[pa.RecordBatch]:
    """Of the blocks of buckets, the families (labels) that candidate pairs connect, as links of each with the smallest: a forest
    without long paths, which would take ``components`` more rounds."""
    for rows in _groups(batches, ("key", "i", "j")):
        col = lambda c: rows.column(c).to_numpy()  # noqa: B023, E731
        key, i, j, own, label, n, full = (col(c) for c in ("key", "i", "j", "own", "label", "n", "full"))
        low = np.stack([col(f"l{q}") for q in range(4)], axis=1).view(_U)
        found = []
        offset, at = 1, np.arange(len(key) - 1)
        while len(at):  # pairs of rows that stand ``offset`` apart, of all groups at once
            to = at + offset
            same = (key[at] == key[to]) & (i[at] == i[to]) & (j[at] == j[to])
            at, to = at[same], to[same]
            ok = (label[at] != label[to]) & ((i[at] == j[at]) | (own[at] != own[to]))
            ok &= 100 * np.minimum(n[at], n[to]) >= percent * np.maximum(n[at], n[to])
            a, b = at[ok], to[ok]
            near = np.bitwise_count(low[a] ^ low[b]).sum(axis=1) <= most_differ(np.minimum(full[a], full[b]), percent / 100)
            a, b = a[near], b[near]
            _, one = np.unique(np.stack([label[a], label[b]], axis=1), axis=0, return_index=True)
            found.append(np.stack([label[a[one]], label[b[one]]], axis=1))
            offset += 1
            at = at[at + offset < len(key)]
        union = Union()
        for a, b in np.concatenate(found).tolist() if found else []:
            union.join(a, b)
        y = np.array([v for v in union.parent if union.find(v) != v], dtype=np.int64)
        yield batch(schema, x=np.array([union.find(v) for v in y.tolist()], dtype=np.int64), y=y)


@tidy
def _family_links(batches: Iterator[pa.RecordBatch], schema: pa.Schema, k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Of each pair of blocks of a family, links between its components (labels), confirmed on the full sets, the most alike first."""
    similarity = percent / 100
    for whole in _groups(batches, ("family", "i", "j")):
        cuts = np.stack([whole.column(c).to_numpy() for c in ("family", "i", "j")], axis=1)
        heads = np.flatnonzero(np.concatenate([[True], (cuts[1:] != cuts[:-1]).any(axis=1)]))
        xs, ys = [], []
        for first, last in zip(heads, [*heads[1:], len(cuts)], strict=True):
            rows = whole.slice(first, last - first)
            label, n, own = (rows.column(c).to_numpy() for c in ("label", "n", "own"))
            if (label == label[0]).all():
                continue
            regs = np.stack([np.frombuffer(r, np.uint16) for r in rows.column("registers").to_pylist()])
            texts = rows.column("text").combine_chunks()
            a, b = np.triu_indices(len(label), 1)
            ok = (label[b] != label[a]) & (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b]))
            if cuts[first, 1] != cuts[first, 2]:
                ok &= own[b] != own[a]
            a, b = a[ok], b[ok]
            pairs = []
            for s in range(0, len(a), PAIRS):
                x, y = a[s : s + PAIRS], b[s : s + PAIRS]
                value, used = estimate(regs[x], regs[y], n[x], n[y])
                good = value >= similarity - MARGIN * np.sqrt(similarity * (1 - similarity) / np.maximum(used, 1))
                pairs.append(np.stack([value[good], x[good], y[good]], axis=1))
            if not pairs:
                continue
            found = np.concatenate(pairs)
            met = np.unique(found[:, 1:].astype(int))
            sets = dict(zip(met.tolist(), (s for c in chunks(texts.take(pa.array(met))) for s in shingle_sets(c, k)), strict=True))
            union = Union()
            for a, b in found[np.argsort(-found[:, 0], kind="stable"), 1:].astype(int).tolist():
                if union.find(int(label[a])) != union.find(int(label[b])):
                    s, t = sets[a], sets[b]
                    common = len(np.intersect1d(s, t, assume_unique=True))
                    if 100 * common >= percent * (len(s) + len(t) - common):
                        union.join(int(label[a]), int(label[b]))
                        xs.append(label[a])
                        ys.append(label[b])
        yield batch(schema, x=np.array(xs, dtype=np.int64), y=np.array(ys, dtype=np.int64))


def _blocks(rows: DataFrame, group: str, size: int, count: DataFrame) -> DataFrame:
    """Rows once for each pair (i, j) of blocks of their group that has theirs (``own``), sorted for a scan by group and pair."""
    rows = rows.join(count.select(group, F.ceil(F.col("m") / size).cast("int").alias("blocks")), group)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other", "blocks")
    return rows.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row for each row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of ``k``-word shingles (words between white space, A-Z lower-cased; a text of fewer
    words has its whole sequence as its one shingle) have a Jaccard similarity of ``percent`` / 100 or more. ``component_id``
    is the smallest doc_id that links reach; ``kept`` marks it. A null text, or one without words, has an empty set and links
    with nothing. Rows that share an id are linked with each other. A null id links with nothing: component_id null, kept
    true. Ids are integers. Texts are used whole; memory holds the sets of CHUNK_BYTES of text, or of the longest one.
    """
    similarity = percent / 100
    rows = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    ddl = "id long, n long, a long, b long, registers binary"
    schema = arrow_schema(ddl)
    sketched = scratch(rows.mapInArrow(lambda x: _sketch(x, schema, k), ddl), "minhash-sketches")
    named = sketched.where("id is not null and n > 0")
    classes = named.groupBy("a", "b").agg(F.min("id").alias("rep"))
    few = few_tasks(sketched)  # for tables of about a row a document, or fewer; only their last shuffle is read by so few tasks
    classes = scratch(classes.coalesce(few), "minhash-classes")
    reps = sketched.join(classes.select("a", "b", F.col("rep").alias("id")), ["a", "b", "id"]).select("id", "n", "registers")
    reps = scratch(reps.dropDuplicates(["id", "n", "registers"]).coalesce(few), "minhash-reps")

    band_ddl = "id long, n long, full int, keys array<long>, low array<long>"
    band_schema = arrow_schema(band_ddl)
    banded = scratch(reps.mapInArrow(lambda x: _band(x, band_schema), band_ddl), "minhash-bands")
    exploded = banded.select("id", F.explode("keys").alias("key"))
    shared = exploded.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key", "lo")
    buckets = scratch(exploded.join(shared, "key"), "minhash-buckets")
    marks = banded.select("id", "n", "full", *[F.get("low", F.lit(q)).alias(f"l{q}") for q in range(4)])

    differ = F.lit(0)
    for q in range(4):
        differ = differ + F.bit_count(F.col(f"x.l{q}").bitwiseXOR(F.col(f"y.l{q}")))
    sizes = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    star = buckets.where("id <> lo").select(F.col("lo").alias("p"), F.col("id").alias("q")).distinct()
    star = star.join(marks.alias("x"), F.col("p") == F.col("x.id")).join(marks.alias("y"), F.col("q") == F.col("y.id"))
    star = scratch(star.where(sizes & (differ <= most_differ(F.least("x.full", "y.full"), similarity))).select(F.col("p").alias("x"), F.col("q").alias("y")), "minhash-star")

    pair_ddl = "x long, y long"
    pair_schema = arrow_schema(pair_ddl)
    def labelled(rows: DataFrame, found: DataFrame, name: str) -> DataFrame:
        """``rows`` with the label of their id's component; an id without a link is its own."""
        return rows.join(found.select(F.col("node").alias("id"), F.col("label").alias("_l")), "id", "left").withColumn(name, F.coalesce("_l", F.col("id"))).drop("_l")

    def several(rows: DataFrame, group: str, label: str) -> DataFrame:
        """Groups whose rows have different labels, with their number of rows."""
        return rows.groupBy(group).agg(F.min(label).alias("lo"), F.max(label).alias("hi"), F.count(F.lit(1)).alias("m")).where("lo < hi")

    # families: what candidate pairs connect; a class is in BANDS buckets, so it has no more smallest ones
    spokes = scratch(thinned(star).coalesce(few), "minhash-spokes")
    starred = components(spokes)
    placed = scratch(labelled(buckets.select("id", "key"), starred, "label"), "minhash-placed")
    cross = _blocks(placed.join(marks, "id"), "key", BUCKET_BLOCK, several(placed, "key", "label"))
    forest = scratch(cross.mapInArrow(lambda b: _forests(b, pair_schema, percent), pair_ddl).distinct().coalesce(few), "minhash-forest")
    families = scratch(joined(starred, components(forest)).coalesce(few), "minhash-families")

    # links with the buckets' smallest classes
    texts = scratch(rows.where("text is not null").join(families.select(F.col("node").alias("id")), "id", "left_semi"), "minhash-texts")
    x, y = (reps.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("registers").alias(f"r{c}")) for c in "xy")
    likely = star.join(x, "x").join(y, "y")
    likely = scratch(likely.mapInArrow(lambda b: _estimated(b, pair_schema, similarity), pair_ddl).distinct().coalesce(few), "minhash-likely")
    tx, ty = (texts.select(F.col("id").alias(c), F.col("text").alias(f"t{c}")) for c in "xy")
    full = likely.join(tx, "x").join(ty, "y")
    links = scratch(thinned(full.mapInArrow(lambda b: _confirmed(b, pair_schema, k, percent), pair_ddl)).coalesce(few), "minhash-links")

    # rows of one id with different sets
    member = named.join(classes, ["a", "b"]).select("id", "rep")
    split = member.groupBy("id").agg(F.min("rep").alias("x"), F.max("rep").alias("hi")).where("x < hi").select("id", "x")
    same = member.join(split, "id").select("x", F.col("rep").alias("y")).coalesce(few)
    linked = components(links.unionByName(same))

    # families that are several components so far
    member = labelled(families.select(F.col("node").alias("id"), F.col("label").alias("family")), linked, "label")
    member = scratch(member, "minhash-members")
    sides = member.join(reps, "id").join(texts, "id")
    compared = _blocks(sides, "family", FAMILY_BLOCK, several(member, "family", "label"))
    extra = scratch(compared.mapInArrow(lambda b: _family_links(b, pair_schema, k, percent), pair_ddl).distinct().coalesce(few), "minhash-extra")

    found = joined(linked, components(extra))
    label = classes.join(found, classes.rep == found.node, "left").select("a", "b", F.coalesce("label", "rep").alias("label"))
    slim = sketched.select("id", "n", "a", "b")
    linked = slim.where("id is not null and n > 0").join(label, ["a", "b"]).select("id", "n", "label")
    out = linked.unionByName(slim.where("id is null or n = 0").select("id", "n", F.col("id").alias("label")))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("label").alias("component_id"), F.coalesce(F.col("id") == F.col("label"), F.lit(True)).alias("kept"))
