"""Mixing sources to target weights by Sainte-Laguë apportionment, with DataFrame functions only.

Every source gets a target by its weight; no target is more than ``most`` times what its source has, and what that leaves over
is shared again. Words are dealt in blocks of BLOCK words. The blocks of the whole mix go to the sources, and those of a
source to its shards, each time by the highest quotients weight / (2 * blocks so far + 1), so quotas are integers.

Of all seats only those near the last one that is given need their quotients: with n parties, ``seats`` seats and weights
that sum to W, the last quotient lies between W / (2 * seats + n) and W / (2 * seats - n), so at most a few seats for each
party are open and all others are settled by a division.

A shard takes some of its documents, in seeded order, as one stream of words. A quota that is more than the stream has takes
all of it, once or more, and the rest as whole blocks, spread over the stream from a seeded phase.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .text import pick, scratch

WORD = r"[^\x20\x09-\x0D]+"
#: words of a block
BLOCK = 16
#: a source comes in this form: whether it is null, and its name
SOURCE = ("none", "source")


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``sources`` (none, source, words) with number (from 0, by code point, null last), weight and target.

    Targets sum to ``share`` times all words, or to ``most`` times them if that is less. One task orders the sources: a row
    for each name of the mix, of which a document has one.
    """
    order = Window.orderBy("none", "source")
    number = (F.row_number().over(order) - 1).alias("number")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    rows = sources.select(*SOURCE, "words", number).withColumn("weight", weight)
    # in the order in which they reach their most; what is left for a source when all before it have theirs
    before = Window.orderBy(F.col("words") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    full = most * F.coalesce(F.sum("words").over(before), F.lit(0))
    rest = F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", (share * F.sum("words").over(Window.partitionBy()) - full) / rest)
    rows = rows.withColumn("stops", F.col("level") * F.col("weight") > most * F.col("words"))
    level = F.min_by(F.when(~F.col("stops"), F.col("level")), F.when(~F.col("stops"), F.struct(F.col("words") / F.col("weight"), "number"))).over(Window.partitionBy())
    return rows.withColumn("target", F.coalesce(F.least(level * F.col("weight"), most * F.col("words")), most * F.col("words")).cast("double")).drop("level", "stops")


def apportion(rows: DataFrame, by: Sequence[str], parties: Sequence[str], weight: str, seats: str) -> DataFrame:
    """``rows`` (a party each, in groups ``by``) with ``quota``: the group's ``seats`` by highest quotients, ties to the first party.

    Columns ``by`` and ``parties`` hold no nulls. A party without weight gets nothing.
    """
    group = Window.partitionBy(*by)
    total, n = F.sum(F.col(weight).cast("double")).over(group), F.count(F.lit(1)).over(group)
    settled = lambda slack: F.floor(F.col(weight) * (F.col(seats) + slack * n / 2) / total + 0.5)
    # one seat further on both sides, so that no rounding of the divisions matters
    base = F.when(total > 0, F.greatest(F.lit(0), settled(-1) - 1)).otherwise(0).cast("long")
    top = F.when((total > 0) & (F.col(weight) > 0), settled(1) + 1).otherwise(0).cast("long")
    rows = rows.withColumns({"base": base, "top": top})
    rows = rows.withColumn("left", F.col(seats) - F.sum("base").over(group))
    open_ = rows.where("top > base").select(*by, *parties, weight, "left", F.explode(F.sequence("base", F.col("top") - 1)).alias("k"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy((F.col(weight) / (2 * F.col("k") + 1)).desc(), *parties, "k"))
    won = open_.withColumn("rank", rank).where("rank <= left").groupBy(*by, *parties).agg(F.count(F.lit(1)).alias("won"))
    out = rows.join(won, [*by, *parties], "left")
    return out.withColumn("quota", F.col("base") + F.coalesce("won", F.lit(0))).drop("base", "top", "left", "won")


def shard_count(rows: int) -> int:
    """Shards for so many documents: their number grows with the square root, as do the documents of a shard."""
    return 1 << max(0, rows.bit_length() // 2 - 3)


def _number(text: Column) -> Column:
    """The first 32 bits of a text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    block: int = BLOCK,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    with_text: bool = False,
) -> DataFrame:
    """Row for each row of ``docs``: doc_id, source, size, source_size, target, shard, passes, blocks, taken, and ``text`` and
    ``mixed`` (what the mix takes of the text, words joined by one space) ``with_text``.

    Sizes are words (runs of what is no white space). Sources in code point order, null last, weigh ``weights``, repeating; the
    mix has ``share`` times all words. ``passes`` is how often the whole document is taken, ``blocks`` (array of first, stop:
    words from 0) what is taken once more; ``taken`` counts the words of both. No document is taken more than ``most`` times.
    Taken and target of a source differ by a block or so for each of its shards, or by the words of a shard that has less
    than a block.

    A null or blank text has no words, and nothing is taken of it; an empty table gives no rows. Null ids are ids of their
    own. Repeated rows each count; rows of one id and text stand next to each other in the stream of their shard. The same
    rows give the same mix, in whatever order and partitions they come. Memory holds one text and its blocks; a window sorts the
    documents (without texts unless ``with_text``) of one source and shard, whose number grows with the square root of all.
    """
    if most < 1 or block < 1 or not weights or min(weights) <= 0:
        raise ValueError("weights must be above 0, most and block at least 1")
    rows = pick(docs, id=id_col, text=text_col, source=source_col)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    thin = rows.select(
        F.col("id").alias("doc_id"),
        F.col("source").isNull().alias("none"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        key.alias("key"),
        F.xxhash64("text").alias("tie"),
        *(["text"] if with_text else []),
    )
    thin = scratch(thin, "mix-rows")
    shards = shard_count(thin.count())
    shard = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % shards
    thin = thin.withColumn("shard", shard.cast("int"))

    cells = scratch(thin.groupBy(*SOURCE, "shard").agg(F.sum("size").alias("words")), "mix-cells")
    named = targets(cells.groupBy(*SOURCE).agg(F.sum("words").alias("words")), weights, share, most)
    named = named.withColumn("seats", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long"))
    named = scratch(apportion(named, [], ["number"], "target", "seats"), "mix-sources")
    per_source = named.select(*SOURCE, "number", "target", F.col("words").alias("source_size"), F.col("quota").alias("seats"))
    quotas = apportion(cells.join(per_source, list(SOURCE)), ["number"], ["shard"], "words", "seats")

    # of a cell's words: whole passes, then blocks, of which the cell has ``whole``
    wanted = F.col("quota") * block
    quotas = quotas.where("words > 0").withColumn("passes", F.least(F.lit(most).cast("long"), F.floor(wanted / F.col("words"))))
    whole = F.floor(F.col("words") / block)
    extra = F.least(whole, F.round((wanted - F.col("passes") * F.col("words")) / block).cast("long"))
    quotas = quotas.withColumns({"whole": whole, "extra": F.when(F.col("passes") < most, extra).otherwise(0)})
    phase = F.when(F.col("whole") > 0, _number(F.concat_ws(":", F.lit(f"{seed}:block"), "number", "shard")) % F.col("whole"))
    quotas = quotas.select(*SOURCE, "shard", "passes", "whole", "extra", phase.alias("phase"))

    stream = Window.partitionBy(*SOURCE, "shard").orderBy("key", F.col("doc_id").asc_nulls_first(), "size", "tie")
    placed = thin.withColumn("stop", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(per_source.drop("seats", "number"), list(SOURCE)).join(quotas, [*SOURCE, "shard"], "left")
    first = F.col("stop") - F.col("size")
    # block j is taken if the count of taken blocks grows at j: they are spread evenly
    upto = lambda j: F.floor((j * F.col("extra") + F.col("phase")) / F.col("whole"))
    last = F.least(F.col("whole") - 1, F.floor((F.col("stop") - 1) / block))
    low = F.floor(first / block)
    blocks = F.when(
        (F.col("size") > 0) & (F.col("extra") > 0) & (low <= last),
        F.transform(
            F.filter(F.sequence(low, last), lambda j: upto(j + 1) > upto(j)),
            lambda j: F.struct((F.greatest(j * block, first) - first).alias("first"), (F.least((j + 1) * block, F.col("stop")) - first).alias("stop")),
        ),
    ).otherwise(F.array().cast("array<struct<first:bigint,stop:bigint>>"))
    placed = placed.withColumns({"passes": F.coalesce("passes", F.lit(0).cast("long")), "blocks": blocks})
    more = F.aggregate("blocks", F.lit(0).cast("long"), lambda n, b: n + b["stop"] - b["first"])
    return placed.select(
        "doc_id",
        F.when(~F.col("none"), F.col("source")).alias("source"),
        "size",
        "source_size",
        "target",
        "shard",
        "passes",
        "blocks",
        (F.col("passes") * F.col("size") + more).alias("taken"),
        *(["text", _mixed()] if with_text else []),
    )


def _mixed() -> Column:
    """The words that ``passes`` and ``blocks`` take of the column ``text``."""
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)
    spans = F.concat(F.array_repeat(F.struct(F.lit(0).cast("long").alias("first"), F.col("size").alias("stop")), F.col("passes").cast("int")), F.col("blocks"))
    with_words = F.transform(F.array(words), lambda w: F.array_join(F.flatten(F.transform(spans, lambda s: F.slice(w, (s["first"] + 1).cast("int"), (s["stop"] - s["first"]).cast("int")))), " "))
    return F.coalesce(with_words[0], F.lit("")).alias("mixed")
