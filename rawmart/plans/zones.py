"""Raw -> staging -> mart steps.

Every step is ``DataFrame(s) -> DataFrame`` so tests compose them without tables; ``plans.job``
wires them to storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawmart import fixed as X
from rawmart import schemas as S
from rawmart.functions import day_of, json_scalar, local_ts_to_utc, safe_double, safe_long, year_bucket
from rawmart.operators.arrays import align_arrays
from rawmart.operators.latest import latest_per_key
from rawmart.operators.quality import DEFAULT_MEASURES, dead_letter, hourly_valid, indicator_valid, split_valid

# ---------------------------------------------------------------- raw batches


def indicator_batch(records: DataFrame, source_file: str = "", materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """Unwrapped indicator records -> ``(raw rows, dead letters)``.

    ``records``: ``indicator_id`` (the requested id), ``payload`` VARIANT, ``ingested_at``, ``extract_run_id``.
    """
    valid, bad = split_valid(records, indicator_valid("payload"), materialize)
    raw = valid.select(
        "ingested_at",
        "extract_run_id",
        F.lit(source_file).alias("source_file"),
        "indicator_id",
        "payload",
    )
    dead = dead_letter(bad, X.INDICATOR_SOURCE, X.INDICATOR_REASON, {"indicator_id": "indicator_id"})
    return raw, dead


def hourly_batch(
    payloads: DataFrame,
    locations: DataFrame,
    enabled_variants: Sequence[str] = X.VARIANTS,
    measures: Sequence[str] = DEFAULT_MEASURES,
    source_file: str = "",
    materialize: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Captured hourly payloads -> ``(raw rows, dead letters)``.

    ``payloads``: ``location_id, source_variant, payload VARIANT, ingested_at, extract_run_id``.
    Coordinates come from configuration; a payload for a location that isn't configured is a dead letter with
    reason ``unknown_location``. ``locations`` is joined on its key; Spark broadcasts it if it is small in bytes.
    A column ``body`` (the captured text) is kept in dead letters of payloads that are not JSON.
    """
    picked = payloads.where(F.col("source_variant").isin(list(enabled_variants)))
    located = picked.join(locations.withColumn("_known", F.lit(True)), "location_id", "left")
    known = F.coalesce("_known", F.lit(False))
    valid, bad = split_valid(located, known & hourly_valid("payload", measures), materialize)
    raw = valid.select(
        "ingested_at",
        "extract_run_id",
        F.lit(source_file).alias("source_file"),
        "location_id",
        "latitude",
        "longitude",
        "source_variant",
        "payload",
    )
    reason = F.concat(F.lit(X.HOURLY_REASON_PREFIX), F.col("source_variant"), F.lit(X.HOURLY_REASON_SUFFIX))
    reason = F.when(F.col("_known").isNull(), F.lit(UNKNOWN_LOCATION)).otherwise(reason)
    evidence = F.coalesce("payload", F.col("body").cast("variant")) if "body" in bad.columns else F.col("payload")
    context = {"location_id": "location_id", "source_variant": "source_variant"}
    dead = dead_letter(bad.withColumn("payload", evidence), X.HOURLY_SOURCE, reason, context)
    return raw, dead


def page_dead_letters(errors: DataFrame) -> DataFrame:
    """Broken pages (``sources.bodies.page_errors``) as dead letters with the captured text as evidence."""
    pages = errors.withColumn("payload", F.col("body").cast("variant"))
    return dead_letter(pages, X.INDICATOR_SOURCE, F.col("reason"), {"indicator_id": "indicator_id", "page_no": F.col("page_no").cast("string")})


def with_ingest_date(raw: DataFrame) -> DataFrame:
    """Raw partition column ``DATE(ingested_at)``."""
    return raw.withColumn(S.RAW_PART, day_of("ingested_at"))


# ---------------------------------------------------------------- staging


def _digest(payload: str = "payload") -> Column:
    # deterministic last-resort tie-breaker for identical (ingested_at, run) rows; to_json sorts keys
    return F.xxhash64(F.to_json(payload))


def indicator_typed(raw: DataFrame) -> DataFrame:
    """Each JSON path extracted once; filters and the window then work on plain columns."""
    return raw.select(
        json_scalar("payload", "$.countryiso3code").alias("country_iso3"),
        json_scalar("payload", "$.country.value").alias("country_name"),
        json_scalar("payload", "$.indicator.id").alias("indicator_id"),
        json_scalar("payload", "$.indicator.value").alias("indicator_name"),
        json_scalar("payload", "$.date").alias("_date"),
        json_scalar("payload", "$.value").alias("_value"),
        "ingested_at",
        "extract_run_id",
    ).select(
        "country_iso3",
        "country_name",
        "indicator_id",
        "indicator_name",
        safe_long("_date").alias("year"),
        safe_double("_value").alias("value_num"),
        "_date",
        "ingested_at",
        "extract_run_id",
        # last tie-breaker of rows of one run: records that agree in it are the same staging row
        F.xxhash64("country_name", "indicator_name", "_date", "_value").alias("_digest"),
    )


UNKNOWN_LOCATION = "unknown_location"
ORDER_COL = "_order"  # the full staging order key as one orderable struct (see ``keep_order``)


def stg_indicator_source(raw: DataFrame, keep_order: bool = False) -> DataFrame:
    """Raw indicator rows -> latest staging row per (country_iso3, indicator_id, year).

    With ``keep_order`` the row keeps ``_order`` = (ingested_at, extract_run_id, digest): merging
    batches with ``recency=[ORDER_COL]`` then gives exactly the all-at-once result, whatever the split.
    """
    return indicator_latest(indicator_typed(raw), keep_order)


def indicator_latest(typed: DataFrame, keep_order: bool = False) -> DataFrame:
    """``stg_indicator_source`` of rows that are typed already."""
    typed = typed.where(_indicator_reason().isNull())
    order = ["ingested_at", "extract_run_id", "_digest"]
    latest = latest_per_key(typed, S.INDICATOR_KEYS, order)
    extra = [F.struct(*order).alias(ORDER_COL)] if keep_order else []
    return latest.select(*S.STG_INDICATOR.fieldNames(), *extra)


def stg_indicator_rejects(raw: DataFrame) -> DataFrame:
    """Rows that passed validity but cannot reach staging (e.g. ``date = "2020Q1"``): made visible."""
    return indicator_refused(indicator_typed(raw))


def _indicator_reason() -> Column:
    return (
        F.when(F.col("country_iso3").isNull(), F.lit("null_country_iso3"))
        .when(F.col("indicator_id").isNull(), F.lit("null_indicator_id"))
        .when(F.col("_date").isNull(), F.lit("null_date"))
        .when(F.col("year").isNull(), F.lit("non_integer_year"))
    )


def indicator_refused(typed: DataFrame) -> DataFrame:
    """``stg_indicator_rejects`` of rows that are typed already."""
    return typed.withColumn("reason", _indicator_reason()).where(F.col("reason").isNotNull()).select(
        "reason", "country_iso3", "indicator_id", F.col("_date").alias("date_text"), "ingested_at", "extract_run_id"
    )


def hourly_rows(raw: DataFrame, tz: str, measures: Sequence[str] = DEFAULT_MEASURES, strict: bool = False) -> DataFrame:
    """Raw hourly payloads -> one typed row per time element (P2, J1-J4, E6, F3), before dedup.

    Includes ``time_text`` and ``pos`` so callers can route unparseable times to rejects.
    """
    keep = ("location_id", "latitude", "longitude", "ingested_at", "extract_run_id", "source_variant", "_digest")
    with_digest = raw.withColumn("_digest", _digest())  # once per payload, before the explode
    rows = align_arrays(
        with_digest,
        "$.hourly.time",
        {m: f"$.hourly.{m}" for m in measures},
        keep=keep,
    )
    return rows.select(
        "location_id",
        "latitude",
        "longitude",
        local_ts_to_utc("time_text", tz, strict=strict).alias("timestamp"),
        *[safe_double(m).alias(m) for m in measures],
        "ingested_at",
        "extract_run_id",
        "source_variant",
        "_digest",
        "pos",
        "time_text",
    )


def stg_hourly_source(
    raw: DataFrame, tz: str, measures: Sequence[str] = DEFAULT_MEASURES, strict: bool = False, keep_order: bool = False
) -> DataFrame:
    """Raw hourly rows -> latest staging row per (location_id, timestamp).

    Ties inside one run (archive and forecast covering one hour, or two local hours mapping to one
    instant) are broken by archive first, then payload digest, then the later array position.
    With ``keep_order`` the row keeps that whole order key as ``_order``, so an archive row staged
    in one micro-batch still beats a forecast row of the same run arriving in a later one.
    """
    return hourly_latest(hourly_rows(raw, tz, measures, strict), measures, keep_order)


def hourly_latest(rows: DataFrame, measures: Sequence[str] = DEFAULT_MEASURES, keep_order: bool = False) -> DataFrame:
    """``stg_hourly_source`` of rows that are aligned and typed already."""
    rows = rows.where(F.col("timestamp").isNotNull())
    rows = rows.withColumn("_archive", F.col("source_variant") == "archive")
    order = ["ingested_at", "extract_run_id", "_archive", "_digest", "pos"]
    latest = latest_per_key(rows, S.HOURLY_KEYS, order, drop_null_keys=True)
    extra = [F.struct(*order).alias(ORDER_COL)] if keep_order else []
    return latest.select(*S.stg_hourly(measures).fieldNames(), *extra)


def stg_hourly_rejects(raw: DataFrame, tz: str, measures: Sequence[str] = DEFAULT_MEASURES) -> DataFrame:
    """Time elements that are present but not ``yyyy-MM-ddTHH:mm`` local time, or have a NULL location."""
    return hourly_refused(hourly_rows(raw, tz, measures))


def hourly_refused(rows: DataFrame) -> DataFrame:
    """``stg_hourly_rejects`` of rows that are aligned and typed already."""
    reason = F.when(F.col("location_id").isNull(), F.lit("null_location_id")).when(
        F.col("timestamp").isNull(), F.lit("bad_time")
    )
    return rows.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(
        "reason", "location_id", "time_text", "pos", "ingested_at", "extract_run_id"
    )


# ---------------------------------------------------------------- marts


def _stg_order(stg: DataFrame) -> list[str]:
    return [ORDER_COL] if ORDER_COL in stg.columns else ["ingested_at", "extract_run_id"]


def mart_indicator_source(stg: DataFrame) -> DataFrame:
    """Staging -> mart rows (lineage dropped); the window protects against non-unique staging."""
    latest = latest_per_key(stg, S.INDICATOR_KEYS, _stg_order(stg))
    return latest.select(*S.MART_INDICATOR.fieldNames())


def mart_hourly_source(stg: DataFrame, measures: Sequence[str] = DEFAULT_MEASURES) -> DataFrame:
    latest = latest_per_key(stg, S.HOURLY_KEYS, _stg_order(stg))
    return latest.select(*S.mart_hourly(measures).fieldNames())


def with_partition(df: DataFrame, kind: str) -> DataFrame:
    """Add the physical partition column of a staging/mart table."""
    if kind == "indicator":
        return df.withColumn(S.INDICATOR_PART, year_bucket("year"))
    return df.withColumn(S.HOURLY_PART, day_of("timestamp"))


# ---------------------------------------------------------------- DDL


def table_layout(measures: Sequence[str] = DEFAULT_MEASURES) -> dict[str, tuple]:
    """Folder below the zone base -> (schema as the files have it, partition column, its SQL type)."""

    def with_order(schema, order):
        return type(schema)([*schema.fields]).add(ORDER_COL, order)

    return {
        f"raw/{X.RAW_INDICATOR_TABLE}": (S.RAW_INDICATOR, S.RAW_PART, "DATE"),
        f"raw/{X.RAW_HOURLY_TABLE}": (S.RAW_HOURLY, S.RAW_PART, "DATE"),
        f"staging/{X.STG_INDICATOR_TABLE}": (with_order(S.STG_INDICATOR, S.INDICATOR_ORDER), S.INDICATOR_PART, "INT"),
        f"staging/{X.STG_HOURLY_TABLE}": (with_order(S.stg_hourly(measures), S.HOURLY_ORDER), S.HOURLY_PART, "DATE"),
        f"mart/{X.MART_INDICATOR_TABLE}": (S.MART_INDICATOR, S.INDICATOR_PART, "INT"),
        f"mart/{X.MART_HOURLY_TABLE}": (S.mart_hourly(measures), S.HOURLY_PART, "DATE"),
    }


def create_zone_tables(spark: SparkSession, base: str, prefix: str = "", measures: Sequence[str] = DEFAULT_MEASURES) -> dict[str, str]:
    """Create the three namespaces (``<prefix>raw``, ``<prefix>staging``, ``<prefix>mart``) and six tables if absent
    (Parquet, partitioned; clustering is done at write time by sorting within partitions).

    Returns table name -> location. A table that is there already but lies elsewhere raises.
    """
    out = {}
    for folder, (schema, part, part_type) in table_layout(measures).items():
        zone, table = folder.split("/")
        name, location = f"{prefix}{zone}.{table}", f"{base.rstrip('/')}/{folder}"
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": f"{prefix}{zone}"})
        if spark.catalog.tableExists(name):
            have = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": name}).where("col_name = 'Location'").first()
            if have is not None and have["data_type"].split(":")[-1].rstrip("/") != location.split(":")[-1].rstrip("/"):
                raise ValueError(f"table {name} lies at {have['data_type']}, not at {location}")
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) ({cols}, `{part}` {part_type}) "
            f"USING parquet PARTITIONED BY (`{part}`) LOCATION '{location}'",
            args={"t": name},
        )
        out[name] = location
    return out


def register_partitions(spark: SparkSession, table: str, part: str, values: Sequence) -> None:
    """Make partitions that were written by path visible in the catalog table (those already known are kept)."""
    values = [v for v in values if v is not None]
    for i in range(0, len(values), 500):
        specs = " ".join(f"PARTITION (`{part}`='{v}')" for v in values[i : i + 500])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(table)
