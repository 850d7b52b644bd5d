"""License scan by diagonal voting, with DataFrame functions only.

Every rolling word pair of a text is looked up among the word pairs of the templates. A hit at word ``at`` of the text and
word ``place`` of a template votes for the diagonal ``at - place``. Votes are summed by diagonal, neighbouring diagonals of
a template (a word too many or too few shifts the diagonal by one) are merged, and a merged span is verified: the words of its
pairs themselves must be equal, not only their hashes, and it must hold ``min_share`` of the template's pairs, or all but
``max_missed`` of them and the template's telling words. A word that is changed, missing or too many costs two pairs at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .text import pick, scratch

# The contract's phrases and labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: the method's own templates and labels
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
}
#: words, or pairs of words, by which a label is told from its likes; templates that hold them are not found without them
TELLING = {
    "mit": ["mit"],
    "apache-2.0": ["apache"],
    "gpl-3.0": ["gnu general", "version 3"],
    "gpl-2.0": ["gnu general", "version 2"],
    "cc-by-nc-4.0": ["nc"],
    "cc-by-sa-4.0": ["sa"],
    "mpl": ["mozilla"],
}
#: pairs made of these words alone are too common to vote
COMMON = {"a", "and", "any", "are", "by", "in", "is", "of", "or", "the", "this", "to", "under", "with"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _pairs(templates: dict[str, str], base: dict[str, str], telling: dict[str, list[str]]) -> list[tuple]:
    """(template number, label, whether base, its number of voting pairs, its words, masks of the places of its telling words,
    place, its bit, first word, second word); phrases of 2 to 63 words."""
    out = []
    for number, (phrase, label) in enumerate([*base.items(), *templates.items()]):
        words = phrase.split()
        pairs = [(i, a, b) for i, (a, b) in enumerate(zip(words, words[1:], strict=False)) if not {a, b} <= COMMON]
        masks = [sum(1 << i for i, a, b in pairs if told in (a, b, f"{a} {b}")) for told in telling.get(label, [])]
        out += [(number, label, phrase in base, len(pairs), len(words), [m for m in masks if m], i, 1 << i, a, b) for i, a, b in pairs]
    return out


def lowered(text):
    """A-Z lower-cased, all other signs kept."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def scan_licenses(docs: DataFrame, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES, min_share: float = 0.9, max_missed: int = 2, max_shift: int = 2, telling: dict[str, list[str]] = TELLING, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row for each row of ``docs``: doc_id, n_words, spans (array of first, last, label, base, share; by first, then label).

    ``base`` phrases have to stand word for word; each place is a span of share 1. Other templates are found, over diagonals at
    most ``max_shift`` apart, with a share of their pairs of at least ``min_share``; or, in a span no longer than the template and
    two shifts, with ``max_missed`` pairs missing, a third of its pairs at most, and all of its ``telling`` words. Phrases have 2 to 63 words. A null
    or empty text has no words and no spans. Repeated rows are kept and scanned each on its own; ids may be null. Very long
    texts are scanned whole; their hits spread over tasks before they are summed.
    """
    table = _pairs(templates, base, telling)
    spark = docs.sparkSession
    lookup = spark.createDataFrame(table, "template int, label string, base boolean, size int, length int, telling array<long>, place int, bit long, w1 string, w2 string").withColumn("gram", F.xxhash64("w1", "w2"))
    hashes = [r["gram"] for r in lookup.select("gram").distinct().collect()]  # as many as the templates have pairs
    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").alias("doc_id"), F.monotonically_increasing_id().alias("row"), lowered(F.coalesce(F.col("text"), F.lit(""))).alias("text"))
    rows = rows.withColumn("words", F.split("text", NO_WORD)).withColumn("words", F.filter("words", lambda w: w != ""))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 2), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1)).isin(hashes))
    at = F.when(F.size("words") >= 2, at).otherwise(F.array().cast("array<int>"))
    rows = rows.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), F.transform(at, lambda i: F.struct(i.alias("at"), F.get("words", i).alias("w1"), F.get("words", i + 1).alias("w2"))).alias("hits"))
    rows = scratch(rows, "license-hits")
    hits = rows.select("row", F.explode("hits").alias("hit")).select("row", "hit.*").withColumn("gram", F.xxhash64("w1", "w2"))
    hits = hits.join(F.broadcast(lookup), ["gram", "w1", "w2"])  # the templates' pairs: as many as their words
    votes = hits.groupBy("row", "template", "label", "base", "size", "length", "telling", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.min("at").alias("first"), (F.max("at") + 1).alias("last"), F.count(F.lit(1)).alias("votes"), F.bit_or("bit").alias("places")
    )
    exact = votes.where(F.col("base") & (F.col("votes") == F.col("size"))).select("row", "first", "last", "label", "base", F.lit(1.0).alias("share"))
    # neighbouring diagonals: a new span begins where the diagonal is more than max_shift past the last one
    by_row = Window.partitionBy("row", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_row) > max_shift, F.lit(True))
    merged = votes.where(~F.col("base")).withColumn("span", F.sum(fresh.cast("int")).over(by_row))
    merged = merged.groupBy("row", "template", "label", "base", "size", "length", "telling", "span").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.bit_or("places").alias("places"))
    got = F.bit_count("places")
    missed = (F.col("size") - got <= F.least(F.lit(max_missed), F.floor(F.col("size") / 3))) & (F.col("last") - F.col("first") < F.col("length") + 2 * max_shift)
    told = F.forall("telling", lambda m: F.col("places").bitwiseAND(m) != 0)
    near = merged.withColumn("share", F.round(got / F.col("size"), 4)).where((F.col("share") >= min_share) | (missed & told)).select("row", "first", "last", "label", "base", "share")
    spans = exact.unionByName(near).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", "last", "label", "base", "share"))).alias("spans"))
    out = rows.select("doc_id", "row", "n_words").join(spans, "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"))
