"""Captured paged response bodies -> records.

Input (one row per captured page): ``indicator_id, page_no, body (JSON text), extract_run_id, ingested_at``.
A body is ``[metadata, records]``. Bodies are read one per row and exploded early, so one huge
body never becomes one huge group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawmart.functions import is_array, is_object, json_array, json_type, parse_once
from rawmart.session import materialize

PAGE_KEYS = ("extract_run_id", "indicator_id")


def _parsed(bodies: DataFrame) -> DataFrame:
    # a body that is not JSON becomes NULL and yields no records, never a failure
    return parse_once(bodies, "body", out="_v")


def _records(v: str = "_v"):
    """Records array of a ``[metadata, records]`` envelope; NULL for any other shape.

    ``$[1]`` resolves only when the root is an array of at least two elements, so no separate root
    test (which would copy the whole body into an array) is needed.
    """
    return json_array(v, "$[1]")


def _pages_value() -> Column:
    """Number of pages the metadata names; the page itself when the field is missing; NULL when it is there but no integer."""
    named = json_type("_v", "$[0].pages").isNotNull()
    return F.when(named, F.try_variant_get("_v", "$[0].pages", "int")).otherwise(F.col("page_no"))


def page_errors(bodies: DataFrame, keys: Sequence[str] = PAGE_KEYS, carry: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """Captured pages that can't be used as they are: ``*keys, *carry, page_no, reason, body``.

    ``page_not_json``: the text is not JSON, so its records are lost and the run of pages ends before it.
    ``bad_pages_value``: ``pages`` is there but no integer, so the page can't end the run of pages.
    """
    cols = [*keys, *carry, "page_no"]
    parsed = parse_once(bodies, "body", out="_v", keep=[*cols, "body"])
    return parsed.select(*cols, _page_error().alias("reason"), "body").where(F.col("reason").isNotNull())


def _page_error() -> Column:
    bad_value = is_array("_v") & _pages_value().isNull()
    return F.when(F.col("body").isNotNull() & F.col("_v").isNull(), "page_not_json").when(bad_value, "bad_pages_value")


def page_stops(bodies: DataFrame, keys: Sequence[str] = PAGE_KEYS) -> DataFrame:
    """``*keys, page_no, stop`` of captured pages: 0 for a page without object records, 1 for one that reaches ``pages``, else 2."""
    parsed = _parsed(bodies.select(*keys, "page_no", "body"))
    n_objects = F.when(_records().isNull(), F.lit(0)).otherwise(F.size(F.filter(_records(), lambda r: is_object(r))))
    stop = F.when(n_objects == 0, 0).when(F.coalesce(F.col("page_no") >= _pages_value(), F.lit(False)), 1).otherwise(2)
    return parsed.select(*keys, "page_no", stop.alias("stop"))


def page_cut(bodies: DataFrame, keys: Sequence[str] = PAGE_KEYS) -> DataFrame:
    """Last page to keep per ``keys`` under the extractor's stop rule.

    Pages are requested 1, 2, 3, ...: stop before an empty page (no object records), stop after a
    page whose number reaches ``metadata.pages`` (text or number; missing -> the page itself; no
    integer -> it ends nothing, see ``page_errors``), and a gap in the captured pages ends the run of pages too.

    One pass over the bodies, then ``_cut``'s two map-side-combined aggregations.
    """
    parsed = _parsed(bodies.select(*keys, "page_no", "body"))
    pages = _pages_value()
    # explicit NULL branch: size(NULL) is NULL under ANSI but -1 without it
    n_objects = F.when(_records().isNull(), F.lit(0)).otherwise(F.size(F.filter(_records(), lambda r: is_object(r))))
    stop = F.when(n_objects == 0, F.col("page_no") - 1).when(F.col("page_no") >= pages, F.col("page_no"))
    return _cut(parsed.select(*keys, F.col("page_no"), stop.alias("_stop")), keys)


def _cut(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``pages``: one row per present page (or per record of it) with ``page_no`` and ``_stop``.

    Emits the page itself (present, with its stop value) and the candidates ``page + 1`` and ``1``
    for "first missing page", then two aggregations, both combined map-side: per (keys, page) and per
    keys. No window and no join, so an indicator holding a third of all pages spreads over many tasks.
    """
    row = "struct<page_no:int,present:int,cand:int,stop:int>"
    rows = pages.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("page_no"), F.lit(1), F.lit(0), F.col("_stop")).cast(row),
                F.struct(F.col("page_no") + 1, F.lit(0), F.lit(1), F.lit(None)).cast(row),
                F.struct(F.lit(1), F.lit(0), F.lit(1), F.lit(None)).cast(row),
            )
        ).alias("r"),
    ).select(*keys, "r.*")
    per_page = rows.groupBy(*keys, "page_no").agg(
        F.max("present").alias("present"), F.max("cand").alias("cand"), F.min("stop").alias("stop")
    )
    missing = F.when((F.col("cand") == 1) & (F.col("present") == 0), F.col("page_no"))
    per_key = per_page.groupBy(*keys).agg(F.min(missing).alias("_missing"), F.min("stop").alias("_stop"))
    gap = F.col("_missing") - 1
    return per_key.select(*keys, F.least(gap, F.coalesce(F.col("_stop"), gap)).alias("last_page"))


def unwrap_pages(
    bodies: DataFrame,
    keys: Sequence[str] = PAGE_KEYS,
    carry: Sequence[str] = ("ingested_at",),
    apply_stop_rule: bool = True,
) -> DataFrame:
    """One row per object record of the kept pages: ``*keys, *carry, page_no, rec_pos, payload (VARIANT)``.

    Non-object records and malformed envelopes are dropped silently, as the extractor does (``page_errors``
    shows pages that are broken).

    Each body is parsed once: the records are exploded with their page's ``pages`` value and written
    once under the shared checkpoint folder; the stop rule is then computed from two small columns
    of that table (an empty or malformed page has no records, so it ends the page run like a gap,
    which is exactly "stop before an empty page"). The kept pages are written as a table of
    (run, indicator, page) and joined on all three, so an indicator with very many records is no hot key;
    Spark broadcasts them if the written table is small in bytes.
    """
    if not apply_stop_rule:
        return _exploded(bodies, keys, carry).where("_ok").select(*keys, *carry, "page_no", "rec_pos", "payload")
    return unwrap_with_errors(bodies, keys, carry)[0]


def _exploded(bodies: DataFrame, keys: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """The records of all pages (``_ok``), and a row with ``reason`` and ``body`` for each broken page."""
    cols = [*keys, *carry, "page_no"]
    parsed = parse_once(bodies, "body", out="_v", keep=[*cols, "body"])
    rows = parsed.select(
        *cols, _pages_value().alias("_pages"), _page_error().alias("reason"), "body", F.posexplode_outer(_records()).alias("rec_pos", "payload")
    )
    first = F.coalesce("rec_pos", F.lit(0)) == 0
    reason = F.when(first, F.col("reason"))
    rows = rows.withColumns({"_ok": is_object("payload"), "reason": reason, "body": F.when(reason.isNotNull(), F.col("body"))})
    return rows.where("_ok or reason is not null")


def unwrap_with_errors(
    bodies: DataFrame, keys: Sequence[str] = PAGE_KEYS, carry: Sequence[str] = ("ingested_at",)
) -> tuple[DataFrame, DataFrame]:
    """``unwrap_pages`` and ``page_errors`` from one parse of each body."""
    table = materialize(_exploded(bodies, keys, carry), "unwrapped")
    recs = table.where("_ok")
    stop = F.when(F.col("page_no") >= F.col("_pages"), F.col("page_no"))
    pages = recs.groupBy(*keys, "page_no").agg(F.min(stop).alias("_stop"))
    cut = _cut(pages, keys)
    kept = materialize(pages.join(cut, list(keys)).where(F.col("page_no") <= F.col("last_page")).select(*keys, "page_no"), "kept_pages")
    out = recs.join(kept, [*keys, "page_no"], "left_semi").select(*keys, *carry, "page_no", "rec_pos", "payload")
    return out, table.where("reason is not null").select(*keys, *carry, "page_no", "reason", "body")
