"""Consumer queries on the marts and dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawmart import schemas as S
from rawmart.operators.latest import latest_per_key
from rawmart.operators.quality import DEFAULT_MEASURES


def latest_value(mart: DataFrame, by: Sequence[str] = ("country_iso3", "indicator_id")) -> DataFrame:
    """C1 KPI: latest non-null value per group: highest year, then the first country and indicator by name.

    With a coarser group than the mart's key (``by=("indicator_id",)``) the row that wins is named by all its key columns.
    """
    known = mart.where(F.col("value_num").isNotNull())
    rest = [c for c in ("country_iso3", "indicator_id") if c not in by]
    return latest_per_key(known, by, ["year", *[F.col(c).asc() for c in rest]]).select(*by, *rest, "year", "value_num")


def annual_series(
    mart: DataFrame, countries: Sequence[str] | None = None, indicators: Sequence[str] | None = None
) -> DataFrame:
    """Yearly series with optional country / indicator filters (pushed to the scan)."""
    out = mart
    if countries is not None:
        out = out.where(F.col("country_iso3").isin(list(countries)))
    if indicators is not None:
        out = out.where(F.col("indicator_id").isin(list(indicators)))
    return out.select("country_iso3", "indicator_id", "year", "value_num").orderBy("country_iso3", "indicator_id", "year")


def hourly_series(mart: DataFrame, locations: Sequence[str] | None = None, start=None, end=None) -> DataFrame:
    """Hourly series with optional location filter and UTC time range ``[start, end)``.

    On the partitioned mart, the time range also bounds ``event_date`` so whole days are pruned.
    """
    out = mart
    if locations is not None:
        out = out.where(F.col("location_id").isin(list(locations)))
    if start is not None:
        out = out.where(F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
        if S.HOURLY_PART in mart.columns:
            out = out.where(F.col(S.HOURLY_PART) >= F.to_date(F.lit(start)))
    if end is not None:
        out = out.where(F.col("timestamp") < F.lit(end).cast("timestamp_ntz"))
        if S.HOURLY_PART in mart.columns:
            out = out.where(F.col(S.HOURLY_PART) <= F.to_date(F.lit(end)))
    return out.select("location_id", "timestamp", *DEFAULT_MEASURES).orderBy("location_id", "timestamp")


def chart_feed(mart: DataFrame, measures: Sequence[str] = DEFAULT_MEASURES) -> DataFrame:
    """C4: long form (location, timestamp, measure, value) for one chart per measure."""
    return mart.unpivot(["location_id", "timestamp"], list(measures), "measure", "value")


def freshness(tables: dict[str, DataFrame], as_of, max_age_hours: float) -> DataFrame:
    """Last landing time per source and whether it is older than ``max_age_hours`` at ``as_of``."""
    parts = [
        df.agg(F.max("ingested_at").alias("last_ingested_at")).select(F.lit(name).alias("source"), "last_ingested_at")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    as_of_ts = F.lit(as_of).cast("timestamp_ntz")
    # difference of two UTC wall times, computed without the session zone (no DST shift)
    age = F.timestamp_diff("MICROSECOND", F.col("last_ingested_at"), as_of_ts) / 3.6e9
    return out.select(
        "source",
        "last_ingested_at",
        age.alias("age_hours"),
        (F.col("last_ingested_at").isNull() | (age > F.lit(max_age_hours))).alias("is_stale"),
    )


def reject_summary(dead: DataFrame, by: Sequence[str] = ("source_name", "reason")) -> DataFrame:
    """Dead letters counted by source and reason (partial aggregation before the shuffle)."""
    return dead.groupBy(*by).agg(F.count(F.lit(1)).alias("rejected"))
