"""High-water marks and run metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawmart.functions import json_array, json_scalar, json_text, truthy


def max_year_cursor(records: DataFrame, by: Sequence[str] = ("indicator_id",), payload: str = "payload") -> DataFrame:
    """Text maximum of truthy ``date`` values per group (text order: "999" > "2022").

    A plain ``groupBy().agg(max)`` so each map task pre-aggregates before the shuffle.
    """
    date_text = F.when(truthy(payload, "$.date"), json_text(payload, "$.date"))
    return records.groupBy(*by).agg(F.max(date_text).alias("max_cursor_value"))


def last_time_cursor(payload="payload") -> Column:
    """Last element of ``hourly.time`` as text (not the maximum); NULL when missing, empty, not an
    array, or when the last element is JSON null or not a scalar."""
    return json_scalar(F.try_element_at(json_array(payload, "$.hourly.time"), F.lit(-1)))


def run_metrics(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row count per group (logged run metrics become a DataFrame)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("records"))


def high_water(df: DataFrame, by: Sequence[str] = (), column: str = "ingested_at") -> DataFrame:
    """Largest ``column`` seen so far (per group); a figure to report, not a place to read on from (see ``unseen_runs``)."""
    return df.groupBy(*by).agg(F.max(column).alias("high_water"))


def unseen_runs(raw: DataFrame, seen: DataFrame, by: Sequence[str] = ("extract_run_id",)) -> DataFrame:
    """Rows of runs that ``seen`` has no row of.

    A time maximum would drop runs with the same stamp as the newest one, and late ones; ``plans.job`` notes each landed
    batch for the same reason. Rows without a run id count as unseen.
    """
    return raw.join(seen.select(*by).distinct(), list(by), "left_anti")
