"""Sharding by histogram sort, with DataFrame functions only.

Rows are ordered by (hash of the text, doc_id). Each round counts the exact bytes of the rows below evenly spaced probes
inside the key interval of each open splitter, and keeps the interval that holds the splitter's target, until a probe lies
within the tolerance of the target or the interval is one key. A second search, over counts of rows, cuts the order into tasks
of about TASK_ROWS rows. Only then the rows are exchanged, once, each to the task that the splitters name.

Law ``bytes``: the shards' sizes are near equal: a shard's upper boundary misses its ideal place by at most ``tolerance``
times the ideal shard size, or by less than one row where rows are larger than that. Equal texts have the same hash and so
stand together; a group of equal texts is only split (by doc_id) where a boundary inside the tolerance falls into it.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .text import pick, scratch

#: each round has 2**PROBE_BITS probes in an open splitter's interval
PROBE_BITS = 10
#: rows of a task of the exchange (half more or less), as long as they make no more than MOST_TASKS tasks
TASK_ROWS, MOST_TASKS = 1 << 16, 1024


class Open(NamedTuple):
    """A splitter in search: its target and how far it may miss it, and the interval that holds it: of keys that begin with
    ``prefix``, or of the places of the key ``group``; ``below``: weight before the interval."""

    target: int
    allowed: float
    below: int = 0
    group: int = 0
    prefix: int = 0


def _sums(rows: DataFrame, field: str, weight: Column, bits_left: int, asked: set[tuple[int, int]]) -> dict[tuple[int, int], dict[int, int]]:
    """Weight by next digit, for each interval (group, prefix) of ``asked``; at most 2**PROBE_BITS sums for each."""
    step = min(PROBE_BITS, bits_left)
    prefix = F.shiftright(field, bits_left) if bits_left < 63 else F.lit(0).cast("long")
    digit = F.shiftright(field, bits_left - step).bitwiseAND((1 << step) - 1)
    group = F.lit(0).cast("long")
    wanted = prefix.isin(sorted({p for _, p in asked}))
    if field == "place":
        group = F.col("key")
        wanted = F.lit(False)
        for g in sorted({g for g, _ in asked}):  # keys with many rows: those that hold a splitter
            wanted |= (group == g) & prefix.isin(sorted(p for h, p in asked if h == g))
    found: dict[tuple[int, int], dict[int, int]] = defaultdict(dict)
    for r in rows.where(wanted).groupBy(group.alias("g"), prefix.alias("p"), digit.alias("d")).agg(weight.alias("s")).collect():
        found[r["g"], r["p"]][r["d"]] = r["s"]
    return found


def _refine(rows: DataFrame, field: str, weight: Column, open_: dict[int, Open]) -> tuple[dict[int, tuple[int, int]], dict[int, Open]]:
    """Splitters on a field of 63 bits: those that are settled, as (group, first field value of the right side), and those
    whose target lies inside one value, which is then their prefix."""
    settled: dict[int, tuple[int, int]] = {}
    bits = 63
    while open_ and bits:
        sums = _sums(rows, field, weight, bits, {(o.group, o.prefix) for o in open_.values()})
        step = min(PROBE_BITS, bits)
        bits -= step
        after = {}
        for k, o in open_.items():
            below = o.below
            here = sums.get((o.group, o.prefix), {})
            for digit in sorted(here):
                value = (o.prefix << step) | digit
                if abs(below - o.target) <= o.allowed:
                    settled[k] = (o.group, value << bits)
                    break
                if below + here[digit] > o.target:
                    if abs(below + here[digit] - o.target) <= o.allowed:
                        settled[k] = (o.group, (value + 1) << bits)
                    else:
                        after[k] = o._replace(prefix=value, below=below)
                    break
                below += here[digit]
            else:  # all of the interval is below the target: the boundary is its upper end
                settled[k] = (o.group, (o.prefix + 1) << (bits + step))
        open_ = after
    return settled, open_


def splitters(rows: DataFrame, weight: Column, targets: dict[int, Open]) -> dict[int, tuple[int, int]]:
    """(key, place) of the first row to the right of each splitter, by its number; none for those past the last key."""
    settled, inside = _refine(rows, "key", weight, targets)
    bounds = {k: (key, 0) for k, (_, key) in settled.items()}
    settled, last = _refine(rows, "place", weight, {k: o._replace(group=o.prefix, prefix=0) for k, o in inside.items()})
    bounds |= settled | {k: (o.group, o.prefix) for k, o in last.items()}
    bounds = {k: (key, place) if place < 1 << 63 else (key + 1, 0) for k, (key, place) in bounds.items()}
    return {k: b for k, b in bounds.items() if b[0] < 1 << 63}


def _passed(bounds: list[tuple[int, int]]) -> Column:
    """How many of the bounds a row's (key, place) has reached."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.struct(F.lit(k).cast("long").alias("key"), F.lit(p).cast("long").alias("place")) for k, p in bounds])
    reached = lambda b: (b["key"] < F.col("key")) | ((b["key"] == F.col("key")) & (b["place"] <= F.col("place")))
    return F.size(F.filter(table, reached))


def histogram_shards(docs: DataFrame, shards: int = 8, tolerance: float = 0.001, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row for each row of ``docs``: doc_id, size, text_crc32, shard, slot (numbered from 0 in each shard, by hash of the text and doc_id).

    Size is the UTF-8 bytes of the text plus 1. A null text counts as no bytes and is one group with the empty text. Repeated
    rows are kept, each with a slot of its own; rows with the same id and text can't be told apart and share a shard. A null
    id sorts before all others. Very long texts count in full. No rows: no rows.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = pick(docs, id=id_col, text=text_col).select(
        F.col("id").alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(body), 1).alias("key"),
    )
    # ids as 63-bit places in their own order; two ids share a place only where they differ in the last bit alone
    place = F.coalesce(F.shiftrightunsigned(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(1 << 63)).cast("long")), 1), F.lit(0).cast("long"))
    rows = scratch(rows.withColumn("place", place), "shard-keys")
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    cuts = splitters(rows, F.sum("size"), {k: Open(total * k // shards, tolerance * total / shards) for k in range(1, shards)} if total else {})
    tasks = min(-(-n // TASK_ROWS), MOST_TASKS)
    more = splitters(rows, F.count(F.lit(1)), {k: Open(n * k // tasks, n / tasks / 2) for k in range(1, tasks)})
    bounds = sorted({*cuts.values(), *more.values()})
    # the one exchange, to the tasks that the splitters name: a task has rows of one shard, and a shard's tasks follow one another
    placed = rows.withColumn("shard", _passed(list(cuts.values()))).withColumn("task", _passed(bounds))
    placed = placed.repartitionById(len(bounds) + 1, F.col("task")).sortWithinPartitions("key", "place", "doc_id", "size", "text_crc32")
    placed = scratch(placed.select("doc_id", "size", "text_crc32", "shard", "task", F.monotonically_increasing_id().alias("at")), "shard-rows")
    runs = placed.groupBy("shard", "task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))  # a row for each task
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    out = placed.join(runs.select("shard", "task", "low", "before"), ["shard", "task"])
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("at") - F.col("low")).cast("long").alias("slot"))
