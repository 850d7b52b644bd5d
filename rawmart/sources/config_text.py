"""Configuration text as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def id_list(text) -> Column:
    """Comma list -> array of trimmed, non-empty ids (order kept)."""
    parts = F.split(_col(text), ",")
    return F.transform(F.filter(parts, lambda e: F.trim(e) != ""), lambda e: F.trim(e))


def parse_locations(df: DataFrame, spec: str = "spec", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id:lat:lon;id:lat:lon`` -> one row per location (location_id, latitude, longitude).

    Blank entries are skipped; the id is the text before the first ``:`` and the rest is split at
    most once more, so a longitude keeps any further ``:``. Fewer than three parts, or a coordinate
    that is not a number, fails the query (configuration errors must stop the run).
    """
    entries = df.select(*keep, F.explode(F.split(_col(spec), ";")).alias("_e")).where(F.trim("_e") != "")
    parts = entries.select(*keep, F.split(F.trim("_e"), ":", 3).alias("_p"))
    checked = parts.select(
        *keep,
        F.when(F.size("_p") < 3, F.raise_error(F.lit("location must be id:latitude:longitude")))
        .otherwise(F.col("_p"))
        .alias("_p"),
    )
    return checked.select(
        *keep,
        F.col("_p")[0].alias("location_id"),
        F.trim(F.col("_p")[1]).cast("double").alias("latitude"),
        F.trim(F.col("_p")[2]).cast("double").alias("longitude"),
    )


def request_window(end_date, days) -> tuple[Column, Column]:
    """Archive window ``(start, end)``: ``start = end - max(days - 1, 0)`` days, both inclusive."""
    end = _col(end_date)
    n = _col(days) if not isinstance(days, int) else F.lit(days)
    return F.date_sub(end, F.greatest(n - 1, F.lit(0))), end


def request_params(locations: DataFrame, variables: Column, tz: str, end_date: Column, days: int) -> DataFrame:
    """Archive request per location (P10, E13, E17): coordinates, comma-joined hourly variables,
    time zone and the inclusive date window ending at ``end_date``."""
    start, end = request_window(end_date, days)
    return locations.select(
        "*",
        F.array_join(variables, ",").alias("hourly"),
        F.lit(tz).alias("timezone"),
        F.date_format(start, "yyyy-MM-dd").alias("start_date"),
        F.date_format(end, "yyyy-MM-dd").alias("end_date"),
    )
