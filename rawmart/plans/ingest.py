"""One run, or one micro-batch, as one commit of a store.

Raw rows, dead letters, rejects, staging, marts, per-entity counts and cursors of a run become visible together. A run that is
killed leaves nothing behind, and of two runs that overlap one is taken again on top of the other, so there is no repair step and no
note of unfinished batches. Nothing but file names and statistics by partition reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawmart import fixed as X
from rawmart import schemas as S
from rawmart.functions import safe_long
from rawmart.operators.cursors import last_time_cursor, max_year_cursor
from rawmart.operators.quality import DEFAULT_MEASURES
from rawmart.operators.snapshots import Store, Transaction, transact
from rawmart.plans import zones
from rawmart.plans.job import Batch, build_batches
from rawmart.session import SHREDDED_VARIANT_WRITE, materialize, scratch_scope, session_conf
from rawmart.sources.config_text import request_window

DEAD, CURSORS, METRICS = "dead_letter/record", "state/cursor", "state/run_metric"
SOURCES = {X.RAW_INDICATOR_TABLE: X.INDICATOR_SOURCE, X.RAW_HOURLY_TABLE: X.HOURLY_SOURCE}


def raw_table(prefix: str) -> str:
    return f"raw/{prefix}"


def reject_table(prefix: str) -> str:
    return f"reject/{prefix}"


def ingest(txn: Transaction, batches: dict[str, Batch], tz: str = "UTC", measures: Sequence[str] = DEFAULT_MEASURES, strict: bool = False) -> list[str]:
    """All that a run writes, in ``txn``. Dead letters are kept also when nothing is valid; staging and marts then stay as they are.

    Returns the raw tables that gained rows. Every row is parsed and typed once: staging and rejects come from one written table.
    """
    landed = []
    for prefix, batch in batches.items():
        entity = "indicator_id" if prefix == X.RAW_INDICATOR_TABLE else "location_id"
        txn.append(DEAD, batch.dead.select(*S.DEAD_LETTER.fieldNames()), "source_name", stats=["ingested_at"])
        with session_conf(txn.spark, SHREDDED_VARIANT_WRITE):
            txn.append(raw_table(prefix), zones.with_ingest_date(batch.raw), S.RAW_PART, [entity, "extract_run_id"], stats=["ingested_at", entity])
        raw = txn.gained(raw_table(prefix))
        txn.append(METRICS, entity_counts(prefix, raw, batch.dead), "source")
        if raw is None:
            continue
        landed.append(prefix)
        if prefix == X.RAW_INDICATOR_TABLE:
            typed = materialize(zones.indicator_typed(raw), "typed")
            source, refused = zones.indicator_latest(typed, keep_order=True), zones.indicator_refused(typed)
            _stage(txn, "indicator", X.STG_INDICATOR_TABLE, X.MART_INDICATOR_TABLE, source, S.INDICATOR_KEYS, S.INDICATOR_PART, ["country_iso3", "indicator_id"], zones.mart_indicator_source)
        else:
            typed = materialize(zones.hourly_rows(raw, tz, measures, strict), "typed")
            source, refused = zones.hourly_latest(typed, measures, keep_order=True), zones.hourly_refused(typed)
            _stage(txn, "hourly", X.STG_HOURLY_TABLE, X.MART_HOURLY_TABLE, source, S.HOURLY_KEYS, S.HOURLY_PART, ["location_id"], lambda stg: zones.mart_hourly_source(stg, measures))
        txn.append(reject_table(prefix), refused, "reason")
        txn.upsert(CURSORS, entity_cursors(prefix, raw), ["source", "entity"], "source", ["entity"], recency=["cursor"])
    return landed


def _stage(txn: Transaction, kind: str, stg: str, mart: str, source: DataFrame, keys, part: str, cluster: list[str], to_mart) -> None:
    """Staging upsert, then the same partitions of the mart from the staging rows just written."""
    stats = [c for c in keys if c != "timestamp"]
    if txn.upsert(f"staging/{stg}", zones.with_partition(source, kind), keys, part, cluster, recency=(zones.ORDER_COL,), stats=stats):
        txn.replace(f"mart/{mart}", zones.with_partition(to_mart(txn.gained(f"staging/{stg}")), kind), part, cluster, stats=stats)


def _entity(prefix: str, dead: bool = False) -> Column:
    at = (lambda c: F.col("context")[c]) if dead else F.col
    return at("indicator_id") if prefix == X.RAW_INDICATOR_TABLE else F.concat_ws("/", at("location_id"), at("source_variant"))


def entity_counts(prefix: str, raw: DataFrame | None, dead: DataFrame) -> DataFrame:
    """G3 as a table: source, entity, extract_run_id, outcome, records; an aggregate over a few columns of what was written."""
    parts = [dead.select(_entity(prefix, dead=True).alias("entity"), "extract_run_id", F.lit("dead_letter").alias("outcome"))]
    if raw is not None:
        parts.append(raw.select(_entity(prefix).alias("entity"), "extract_run_id", F.lit("valid").alias("outcome")))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    counts = both.groupBy("entity", "extract_run_id", "outcome").agg(F.count(F.lit(1)).alias("records"))
    return counts.select(F.lit(SOURCES[prefix]).alias("source"), "entity", "extract_run_id", "outcome", "records")


def entity_cursors(prefix: str, raw: DataFrame) -> DataFrame:
    """G1/G2 as a table: source, entity, cursor; entities without one are left out."""
    if prefix == X.RAW_INDICATOR_TABLE:
        found = max_year_cursor(raw).select(F.col("indicator_id").alias("entity"), F.col("max_cursor_value").alias("cursor"))
    else:
        found = raw.groupBy(_entity(prefix).alias("entity")).agg(F.max(last_time_cursor()).alias("cursor"))
    return found.where("cursor is not null").select(F.lit(SOURCES[prefix]).alias("source"), "entity", "cursor")


def run_once(
    spark: SparkSession,
    store: Store,
    indicator_bodies: DataFrame | None,
    hourly_bodies: DataFrame | None,
    locations: DataFrame,
    run_id: str | None,
    ingested_at: str | None,
    tz: str = "UTC",
    enabled_variants: Sequence[str] = X.VARIANTS,
    measures: Sequence[str] = DEFAULT_MEASURES,
    indicator_ids: Sequence[str] | DataFrame | None = None,
    strict: bool = False,
) -> list[str]:
    """O1: one run as one commit; arguments as those of ``plans.job.run_job``. Returns the raw tables that gained rows.

    Bodies are unwrapped and checked once, before the transaction; if another run changes the same partitions meanwhile, only the
    writes are done again.
    """
    with scratch_scope(spark):
        batches = build_batches(indicator_bodies, hourly_bodies, locations, run_id, ingested_at, enabled_variants, measures, indicator_ids, strict)
        return transact(store, lambda txn: ingest(txn, batches, tz, measures, strict))


# ---------------------------------------------------------------- requests from cursors


def cursors(store: Store, version: int | None = None) -> DataFrame:
    """source, entity, cursor of one version: what the marts of that version hold goes up to them."""
    state = store.state(version)
    if CURSORS not in state.tables:
        return store.spark.createDataFrame([], "source string, entity string, cursor string")
    return store.read(CURSORS, state=state).select("source", "entity", "cursor")


def hourly_requests(known: DataFrame, locations: DataFrame, variables: Column, tz: str, end_date: Column, days: int, variant: str = "archive") -> DataFrame:
    """The next archive request of each location: from the day its cursor lies in (read again, as it may be incomplete) to ``end_date``.

    A location without a cursor asks for the last ``days`` days; a cursor past ``end_date`` asks for that day.
    """
    start, end = request_window(end_date, days)
    mine = known.where(F.col("source") == X.HOURLY_SOURCE).where(F.substring_index("entity", "/", -1) == variant)
    mine = mine.select(F.expr(f"left(entity, length(entity) - {len(variant) + 1})").alias("location_id"), F.expr("try_cast(left(cursor, 10) AS DATE)").alias("_day"))
    return locations.join(mine, "location_id", "left").select(
        *locations.columns,
        F.array_join(variables, ",").alias("hourly"),
        F.lit(tz).alias("timezone"),
        F.date_format(F.least(F.coalesce("_day", start), end), "yyyy-MM-dd").alias("start_date"),
        F.date_format(end, "yyyy-MM-dd").alias("end_date"),
    )


def indicator_requests(known: DataFrame, ids: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """The next request of each indicator (column ``indicator_id``): ``date`` as ``<from>:<to>``, from the cursor's year on."""
    mine = known.where(F.col("source") == X.INDICATOR_SOURCE).select(F.col("entity").alias("indicator_id"), safe_long(F.substring("cursor", 1, 4)).alias("_year"))
    year = F.least(F.coalesce("_year", F.lit(first_year)), F.lit(last_year))
    return ids.join(mine, "indicator_id", "left").select(*ids.columns, F.concat_ws(":", year.cast("string"), F.lit(str(last_year))).alias("date"))
