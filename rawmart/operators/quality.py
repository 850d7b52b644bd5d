"""Record validity, valid/dead-letter split and the dead-letter envelope."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawmart.fixed import MEASURES
from rawmart.functions import is_object, json_array, truthy

DEFAULT_MEASURES = MEASURES


def indicator_valid(payload="payload") -> Column:
    """``country`` and ``indicator`` are objects and ``countryiso3code``, ``indicator.id``, ``date`` are truthy."""
    return (
        is_object(payload, "$.country")
        & is_object(payload, "$.indicator")
        & truthy(payload, "$.countryiso3code")
        & truthy(payload, "$.indicator.id")
        & truthy(payload, "$.date")
    )


def hourly_valid(payload="payload", measures: Sequence[str] = DEFAULT_MEASURES) -> Column:
    """``hourly`` is an object; ``time`` and every measure are arrays of one equal, non-zero length."""
    time_len = F.size(json_array(payload, "$.hourly.time"))
    # a path below ``hourly`` resolves only when ``hourly`` is an object, so the arrays being present
    # already proves it; no type walk over the (large) hourly object is needed
    cond = time_len > 0
    for m in measures:
        cond = cond & (F.size(json_array(payload, f"$.hourly.{m}")) == time_len)
    # size(NULL) is NULL under ANSI, so a missing array makes the whole test NULL -> false
    return F.coalesce(cond, F.lit(False))


def split_valid(df: DataFrame, valid: Column, materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """Evaluate ``valid`` once into a column and return ``(valid_rows, rejected_rows)``.

    ``valid`` must never be NULL (use the helpers above), so every input row lands on exactly one side.
    With ``materialize`` the flagged rows are written once under the shared checkpoint folder, so
    the emptiness gates and both writes read them back instead of parsing the bodies again, and a
    lost executor recomputes nothing upstream.
    """
    flagged = df.withColumn("_valid", valid)
    if materialize:
        from rawmart.session import materialize as _materialize

        flagged = _materialize(flagged, "batch")
    valid_rows = flagged.where(F.col("_valid")).drop("_valid")
    rejected = flagged.where(~F.col("_valid")).drop("_valid")
    return valid_rows, rejected


def dead_letter(
    rejected: DataFrame,
    source_name: str,
    reason: Column | str,
    context: Mapping[str, Column | str] | None = None,
    payload: str = "payload",
) -> DataFrame:
    """Dead-letter envelope: source_name, reason, ingested_at, extract_run_id, context map, payload."""
    reason_col = F.lit(reason) if isinstance(reason, str) else reason
    pairs: list[Column] = []
    for key, value in (context or {}).items():
        pairs += [F.lit(key), F.col(value) if isinstance(value, str) else value]
    ctx = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return rejected.select(
        F.lit(source_name).alias("source_name"),
        reason_col.alias("reason"),
        F.col("ingested_at"),
        F.col("extract_run_id"),
        ctx.alias("context"),
        F.col(payload).alias("payload"),
    )
