"""Registered queries over stores: runs, streams, requests and upkeep on versioned tables."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawmart import fixed as X
from rawmart import schemas as S
from rawmart.operators import snapshots
from rawmart.operators.snapshots import Store, transact
from rawmart.plans import ingest as I
from rawmart.plans import zones
from rawmart.queries import _AS_OF, _HOURLY, _HSTG, _IND_TYPED, _STG_IND, ORACLE, _locations, _raw_indicator, _scratch, register
from rawmart.run_queries import _BOTH, _both_marts, _events
from rawmart.session import materialize
from rawmart.sources import driver_tables as D


def _store(spark: SparkSession, name: str) -> Store:
    return Store(spark, _scratch(spark, name))


def _run(spark: SparkSession, sf_dir: str, store: Store, events: DataFrame, run_id: str = "this_run", locations: DataFrame | None = None) -> list[str]:
    locations = _locations(spark, sf_dir) if locations is None else locations
    return I.run_once(spark, store, D.event_bodies(events), D.hourly_bodies(events), locations, run_id, "2030-01-01T00:00:00", tz=D.HOURLY_TZ)


def _marts(store: Store) -> DataFrame:
    state = store.state()  # both marts of one version
    return _both_marts(*(store.read(f"mart/{t}", state=state) for t in (X.MART_INDICATOR_TABLE, X.MART_HOURLY_TABLE)))


@register("upsert_snapshot", _STG_IND + "\nSELECT * FROM stg")
def upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches, older ones after newer ones and the last one twice, upserted as versions; the newest version is read."""
    store = _store(spark, "upsert_snapshot")
    raw = _raw_indicator(spark, sf_dir)
    for part in (2, 0, 1, 1):
        source = zones.stg_indicator_source(raw.where(F.dayofmonth("ingested_at") % 3 == part), keep_order=True)
        rows = zones.with_partition(source, "indicator")
        transact(store, lambda txn: txn.upsert("staging/t", rows, S.INDICATOR_KEYS, S.INDICATOR_PART, ["country_iso3"], recency=(zones.ORDER_COL,)))  # noqa: B023
    return store.read("staging/t").select(*S.STG_INDICATOR.fieldNames())


@register("upsert_bucketed", _STG_IND + "\nSELECT * FROM stg")
def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``upsert_snapshot``, into a table bucketed by its keys, so that every upsert shuffles its source only."""
    store = _store(spark, "upsert_bucketed")
    raw = _raw_indicator(spark, sf_dir)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for part in (2, 0, 1, 1):
        source = zones.stg_indicator_source(raw.where(F.dayofmonth("ingested_at") % 3 == part), keep_order=True)
        rows = zones.with_partition(source, "indicator")
        transact(store, lambda txn: txn.upsert("staging/t", rows, S.INDICATOR_KEYS, S.INDICATOR_PART, ["country_iso3"], recency=(zones.ORDER_COL,), buckets=buckets))  # noqa: B023
    return store.read("staging/t").select(*S.STG_INDICATOR.fieldNames())


@register("versioned_run", f"{_BOTH}")
def versioned_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: two runs, the older days after the newer ones, each as one commit; both marts of the newest version."""
    store = _store(spark, "versioned_run")
    for part in (1, 0):
        _run(spark, sf_dir, store, _events(spark, sf_dir, part, 2), f"run{part}")
    return _marts(store)


@register("overlapping_runs", f"{_BOTH}")
def overlapping_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: two runs over the two halves of all days at the same time; they end as if one had followed the other."""
    store = _store(spark, "overlapping_runs")
    failed: list[BaseException] = []

    def one(part: int) -> None:
        try:
            _run(spark, sf_dir, store, _events(spark, sf_dir, part, 2), f"run{part}")
        except BaseException as e:  # noqa: BLE001  handed to the caller's thread
            failed.append(e)

    threads = [threading.Thread(target=one, args=(part,)) for part in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failed:
        raise failed[0]
    return _marts(store)


@register(
    "cursor_requests",
    f"""WITH {_HOURLY},
ev AS (SELECT * FROM events WHERE day(ts) % 2 = 0),
year AS (SELECT event_type || '_' || (user_id // {D.USERS_PER_LOCATION}) AS id, max(2000 + hour(ts) || CASE WHEN event_id % 23 = 0 THEN 'Q1' ELSE '' END) AS c
         FROM ev WHERE event_id % 43 <> 0 GROUP BY 1),
ids AS (SELECT DISTINCT event_type || '_' || (user_id // {D.USERS_PER_LOCATION}) AS id FROM events),
places AS (SELECT DISTINCT location_id FROM hb),
last AS (SELECT location_id, max(CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 41 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M') ELSE strftime(ts, '%Y-%m-%dT%H:00') END) AS c
         FROM hb WHERE pos = n - 1 AND day(ts) % 2 = 0 AND source_variant = 'archive' AND NOT (no_hourly OR short_precip OR no_wind) GROUP BY 1)
SELECT 'world_bank' AS source, ids.id AS entity, least(coalesce(left(c, 4), '1960'), '2030') || ':2030' AS asks FROM ids LEFT JOIN year USING (id)
UNION ALL
SELECT 'open_meteo', location_id, coalesce(left(c, 10), '2029-12-25') || ':2029-12-31' FROM places LEFT JOIN last USING (location_id)""",
)
def cursor_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a run over the even days, the requests of the next one start where its committed cursors are."""
    store = _store(spark, "cursor_requests")
    _run(spark, sf_dir, store, _events(spark, sf_dir, 0, 2), "run0")
    known = I.cursors(store)
    events = D.table(spark, sf_dir, "events")
    ids = D.event_bodies(events).select("indicator_id").distinct()
    years = I.indicator_requests(known, ids, 1960, 2030)
    days = I.hourly_requests(known, _locations(spark, sf_dir), F.array(*[F.lit(m) for m in X.MEASURES]), D.HOURLY_TZ, F.lit("2029-12-31").cast("date"), 7)
    one = years.select(F.lit(X.INDICATOR_SOURCE).alias("source"), F.col("indicator_id").alias("entity"), F.col("date").alias("asks"))
    return one.unionByName(days.select(F.lit(X.HOURLY_SOURCE).alias("source"), F.col("location_id").alias("entity"), F.concat_ws(":", "start_date", "end_date").alias("asks")))


def _bodies_stream(spark: SparkSession, base: str, bodies: DataFrame, batches: int) -> DataFrame:
    """Captured bodies as landed files and as a stream over them: ``batches`` micro-batches, each with a file for every core."""
    files = max(2, spark.sparkContext.defaultParallelism)
    bodies.repartition(files * batches).write.parquet(f"{base}/bodies")
    return spark.readStream.schema(bodies.schema).option("maxFilesPerTrigger", str(files)).parquet(f"{base}/bodies")


def _stream(spark: SparkSession, sf_dir: str, name: str, die: bool) -> Store:
    """The hourly bodies as a stream. With ``die`` the process dies after each of the first two commits, before the checkpoint notes
    the batch, and starts again."""
    from pyspark.errors import StreamingQueryException

    from rawmart.streaming import exact

    store = _store(spark, name)
    bodies = _bodies_stream(spark, store.base, D.hourly_bodies(D.table(spark, sf_dir, "events")), 3)
    known = materialize(_locations(spark, sf_dir).where(F.substring("location_id", 2, 6).cast("int") % 3 != 0), "locations")  # read by every batch
    left = [2 if die else 0]

    def committed(number: int) -> None:
        if left[0]:
            left[0] -= 1
            raise RuntimeError("died after the commit")

    while True:
        try:
            exact.stream_hourly(spark, store, bodies, known, f"{store.base}/checkpoint", "hourly", D.HOURLY_TZ, after_commit=committed)
            break
        except StreamingQueryException as e:
            if "died after the commit" not in str(e):
                raise
    return store


_KNOWN = "CAST(substr(location_id, 2) AS INTEGER) % 3 <> 0"


@register(
    "stream_exactly_once",
    f"""WITH {_HOURLY},
body AS (SELECT location_id, source_variant, extract_run_id, bool_or(no_hourly OR short_precip OR no_wind) AS bad FROM hb GROUP BY ALL)
SELECT 'raw' AS what, count(*) AS n FROM body WHERE NOT bad AND {_KNOWN}
UNION ALL SELECT 'dead_letter', count(*) FROM body WHERE bad OR NOT {_KNOWN}
UNION ALL SELECT 'reject', count(*) FROM hrow WHERE body_valid AND timestamp IS NULL AND {_KNOWN}
UNION ALL SELECT 'counted', count(*) FROM body
UNION ALL SELECT 'mart', count(DISTINCT (location_id, timestamp)) FROM hrow WHERE body_valid AND timestamp IS NOT NULL AND {_KNOWN}""",
)
def stream_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that are replayed after their commit add no raw, dead-letter, reject or count row."""
    store = _stream(spark, sf_dir, "stream_exactly_once", die=True)
    names = {"raw": I.raw_table(X.RAW_HOURLY_TABLE), "dead_letter": I.DEAD, "reject": I.reject_table(X.RAW_HOURLY_TABLE), "mart": f"mart/{X.MART_HOURLY_TABLE}"}
    parts = [store.read(t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("what"), "n") for k, t in names.items()]
    out = store.read(I.METRICS).agg(F.coalesce(F.sum("records"), F.lit(0)).alias("n")).select(F.lit("counted").alias("what"), "n")
    for p in parts:
        out = out.unionByName(p)
    return out


@register(
    "stream_dead_letters",
    f"""WITH {_HOURLY},
body AS (SELECT location_id, source_variant, extract_run_id, bool_or(no_hourly OR short_precip OR no_wind) AS bad FROM hb GROUP BY ALL)
SELECT CASE WHEN {_KNOWN} THEN 'invalid_' || source_variant || '_payload' ELSE 'unknown_location' END AS reason, location_id, count(*) AS n
FROM body WHERE bad OR NOT {_KNOWN} GROUP BY ALL""",
)
def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream could not take, with its reason."""
    store = _stream(spark, sf_dir, "stream_dead_letters", die=False)
    return store.read(I.DEAD).groupBy("reason", F.col("context")["location_id"].alias("location_id")).agg(F.count(F.lit(1)).alias("n"))


@register("stream_page_cut", "WITH cut AS (" + ORACLE["page_cut"] + ") SELECT * FROM cut WHERE last_page > 0")
def stream_page_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page rule with state over a stream in which the pages of a response come in different micro-batches, in any order."""
    from rawmart.streaming import exact

    store = _store(spark, "stream_page_cut")
    bodies = _bodies_stream(spark, store.base, D.indicator_bodies(D.table(spark, sf_dir, "orders")), 3)
    exact.stream_pages(spark, bodies, f"{store.base}/checkpoint", store, "pages")
    return store.read("capture/kept_page").groupBy("extract_run_id", "indicator_id").agg(F.max("page_no").alias("last_page"))


@register(
    "raw_compaction",
    """SELECT 'run_' || strftime(ts, '%Y%m%d') AS extract_run_id, CAST(CAST(ts AS DATE) + 1 AS DATE) AS ingest_date, count(*) AS n, 1 AS folders
       FROM events WHERE event_id % 43 <> 0 GROUP BY 1, 2""",
)
def raw_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: four appends of all days' rows, then upkeep: each day lies in one folder, with the rows of all appends."""
    store = _store(spark, "raw_compaction")
    events = D.table(spark, sf_dir, "events")
    batches = I.build_batches(D.event_bodies(events), None, _locations(spark, sf_dir), "run", "2030-01-01T00:00:00")
    raw = zones.with_ingest_date(batches[X.RAW_INDICATOR_TABLE].raw)
    table = I.raw_table(X.RAW_INDICATOR_TABLE)
    for part in range(4):
        rows = raw.where(F.pmod(F.xxhash64("indicator_id"), F.lit(4)) == part)
        transact(store, lambda txn: txn.append(table, rows, S.RAW_PART, stats=["ingested_at"]))  # noqa: B023
    store.compact(table)
    state = store.state()
    found = store.read(table, state=state).groupBy("extract_run_id", S.RAW_PART).agg(F.count(F.lit(1)).alias("n"))
    folders: dict[str, int] = {}
    for e in state.tables[table].entries:
        folders[e.folder.split("=", 1)[1]] = folders.get(e.folder.split("=", 1)[1], 0) + 1
    per_day = spark.createDataFrame(list(folders.items()), "day string, folders int").withColumn("day", F.col("day").cast("date"))
    return found.join(per_day, F.col(S.RAW_PART) == F.col("day")).drop("day")


@register(
    "field_addition",
    f"""WITH {_IND_TYPED.strip()}
SELECT country_iso3, indicator_id, date_text, CASE WHEN day(ts) % 2 = 1 THEN extract('hour' FROM ts)::INTEGER END AS added FROM ind WHERE is_valid""",
)
def field_addition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: rows of the odd days bring a field that older files don't have; it is null in their rows."""
    store = _store(spark, "field_addition")
    events = D.table(spark, sf_dir, "events")
    for odd in (0, 1):
        rows = events.where(F.dayofmonth("ts") % 2 == odd)
        raw, _ = zones.indicator_batch(D.indicator_records(rows))
        typed = zones.indicator_typed(raw).select("country_iso3", "indicator_id", F.col("_date").alias("date_text"), "extract_run_id")
        typed = typed.withColumn("bucket", F.pmod(F.xxhash64("extract_run_id"), F.lit(4)).cast("int"))
        if odd:
            hours = rows.select(F.lpad(F.col("event_id").cast("string"), 10, "0").alias("extract_run_id"), F.hour("ts").alias("added"))
            typed = typed.join(hours, "extract_run_id")
        transact(store, lambda txn: txn.append("raw/t", typed, "bucket"))  # noqa: B023
    return store.read("raw/t").select("country_iso3", "indicator_id", "date_text", "added")


@register("freshness_stats", ORACLE["freshness"])
def freshness_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last landing times from the committed statistics."""
    store = _store(spark, "freshness_stats")
    events = D.table(spark, sf_dir, "events")
    hourly = I.build_batches(None, D.hourly_bodies(events), _locations(spark, sf_dir), None, None)[X.RAW_HOURLY_TABLE].raw
    transact(store, lambda txn: [
        txn.append("raw/i", zones.with_ingest_date(_raw_indicator(spark, sf_dir)), S.RAW_PART, stats=["ingested_at"]),
        txn.append("raw/h", zones.with_ingest_date(hourly), S.RAW_PART, stats=["ingested_at"]),
    ])
    return snapshots.freshness(store, {X.INDICATOR_SOURCE: "raw/i", X.HOURLY_SOURCE: "raw/h"}, _AS_OF, 24)


@register(
    "run_metric_table",
    f"""WITH {_HOURLY},
body AS (SELECT location_id, source_variant, extract_run_id, bool_or(no_hourly OR short_precip OR no_wind) AS bad FROM hb GROUP BY ALL)
SELECT 'open_meteo' AS source, location_id || '/' || source_variant AS entity, CASE WHEN bad THEN 'dead_letter' ELSE 'valid' END AS outcome, count(*) AS records
FROM body GROUP BY ALL""",
)
def run_metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by entity and outcome as a table that is committed with the run; nothing is collected."""
    store = _store(spark, "run_metric_table")
    I.run_once(spark, store, None, D.hourly_bodies(D.table(spark, sf_dir, "events")), _locations(spark, sf_dir), None, None, tz=D.HOURLY_TZ)
    return store.read(I.METRICS).groupBy("source", "entity", "outcome").agg(F.sum("records").alias("records"))


@register(
    "clustered_read",
    f"""{_HSTG}
SELECT location_id, timestamp, temperature_2m, true AS few_folders FROM hstg WHERE temperature_2m BETWEEN 40 AND 60 AND location_id BETWEEN 'L000010' AND 'L000015'""",
)
def clustered_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly mart clustered by location and temperature over all files; a filter on both reads a part of the folders."""
    from rawmart.operators.clustering import CELL, with_cells

    store = _store(spark, "clustered_read")
    raw = I.build_batches(None, D.hourly_bodies(D.table(spark, sf_dir, "events")), _locations(spark, sf_dir), None, None)[X.RAW_HOURLY_TABLE].raw
    mart = zones.mart_hourly_source(zones.stg_hourly_source(raw, D.HOURLY_TZ))
    keys = ["location_id", "temperature_2m"]
    cells = with_cells(mart, keys)
    transact(store, lambda txn: txn.append("mart/clustered", cells, CELL, keys, stats=keys))
    found = store.read("mart/clustered", between={"location_id": ("L000010", "L000015"), "temperature_2m": (40, 60)})
    all_of = len(store.state().tables["mart/clustered"].entries)
    read = len({f.rsplit("/", 1)[0] for f in found.inputFiles()})
    found = found.where("temperature_2m BETWEEN 40 AND 60 AND location_id BETWEEN 'L000010' AND 'L000015'")
    return found.select("location_id", "timestamp", "temperature_2m", F.lit(2 * read <= all_of).alias("few_folders"))
