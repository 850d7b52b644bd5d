"""Registered queries over whole runs (``run_job``, ``merge_upsert``): default paths, repair, switches, sinks, catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawmart import fixed as X
from rawmart import schemas as S
from rawmart.plans import zones
from rawmart.plans.job import Zones, run_job
from rawmart.queries import _HOURLY, _HSTG, _STG_IND, _latest_hourly_sql, _locations, _raw_indicator, _scratch, register
from rawmart.sources import driver_tables as D

# records of D.event_bodies that reach staging, and the mart of all runs; equal records of one key and run are one
_EVENT_MART = """
ev AS (
  SELECT 'U' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS country_iso3, event_type AS indicator_id,
         CAST(2000 + hour(ts) AS BIGINT) AS year, CAST(user_id * 7 + hour(ts) * 3 + day(ts) AS DOUBLE) AS value_num, CAST(ts AS DATE) AS day
  FROM events WHERE event_id % 43 <> 0 AND event_id % 23 <> 0
),
imart AS (
  SELECT country_iso3, indicator_id, year, value_num FROM (
    SELECT *, row_number() OVER (PARTITION BY country_iso3, indicator_id, year ORDER BY day DESC) AS rn FROM ev
  ) WHERE rn = 1
)"""
_BOTH = f"""{_HSTG}, {_EVENT_MART}
SELECT 'indicator' AS mart, country_iso3 AS entity, indicator_id AS detail, CAST(year AS VARCHAR) AS moment,
       value_num AS v1, CAST(NULL AS DOUBLE) AS v2, CAST(NULL AS DOUBLE) AS v3 FROM imart
UNION ALL
SELECT 'hourly', location_id, NULL, strftime(timestamp, '%Y-%m-%d %H:%M:%S'), temperature_2m, precipitation, wind_speed_10m FROM hstg"""


def _events(spark: SparkSession, sf_dir: str, part: int | None = None, parts: int = 4) -> DataFrame:
    """All events, or those of every ``parts``-th day: runs then bring older days after newer ones."""
    ev = D.table(spark, sf_dir, "events")
    return ev if part is None else ev.where(F.dayofmonth("ts") % parts == part)


def _run(spark: SparkSession, sf_dir: str, z: Zones, events: DataFrame, run_id="this_run", at="2030-01-01T00:00:00", locations=None, **how):
    locations = _locations(spark, sf_dir) if locations is None else locations
    return run_job(spark, z, D.event_bodies(events), D.hourly_bodies(events), locations, run_id, at, tz=D.HOURLY_TZ, **how)


def _both_marts(indicator: DataFrame, hourly: DataFrame) -> DataFrame:
    none = F.lit(None).cast("double")
    a = indicator.select(
        F.lit("indicator").alias("mart"), F.col("country_iso3").alias("entity"), F.col("indicator_id").alias("detail"),
        F.col("year").cast("string").alias("moment"), F.col("value_num").alias("v1"), none.alias("v2"), none.alias("v3"),
    )
    b = hourly.select(
        F.lit("hourly").alias("mart"), F.col("location_id").alias("entity"), F.lit(None).cast("string").alias("detail"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("moment"), F.col("temperature_2m").alias("v1"), F.col("precipitation").alias("v2"), F.col("wind_speed_10m").alias("v3"),
    )
    return a.unionByName(b)


def _marts(spark: SparkSession, z: Zones) -> DataFrame:
    return _both_marts(spark.read.parquet(z.mart_indicator), spark.read.parquet(z.mart_hourly))


@register("run_repair", f"{_BOTH}")
def run_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: four runs; the second ends after landing, the third before its marts. The fourth run, with default arguments,
    stages what they left: both marts equal those of all raw rows."""
    z = Zones(_scratch(spark, "run_repair"))
    for part, how in enumerate([{}, {"steps": []}, {"steps": ["stage_indicator", "stage_hourly"]}, {}]):
        _run(spark, sf_dir, z, _events(spark, sf_dir, part), f"run{part}", **how)
    return _marts(spark, z)


@register("run_captured_stamps", f"{_BOTH}")
def run_captured_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job over bodies that were captured by many runs; each keeps its own run and time, so the latest
    capture wins for every key, whatever this job's stamps are."""
    z = Zones(_scratch(spark, "run_captured_stamps"))
    _run(spark, sf_dir, z, _events(spark, sf_dir))
    return _marts(spark, z)


@register("bi_mart_read", f"{_BOTH}")
def bi_mart_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both marts as a BI tool reads them, by their catalog names; the tables are made before the first run,
    and the second run's partitions are visible too."""
    z = Zones(_scratch(spark, "bi_mart_read"))
    zones.create_zone_tables(spark, z.base, z.namespace)
    for part in range(2):
        _run(spark, sf_dir, z, _events(spark, sf_dir, part, 2), f"run{part}")
    name = lambda table: z.table(f"mart/{table}")
    return _both_marts(spark.table(name(X.MART_INDICATOR_TABLE)), spark.table(name(X.MART_HOURLY_TABLE)))


@register(
    "run_stamps",
    """SELECT 'run_0007' AS extract_run_id, TIMESTAMP '2024-03-01 03:00:00.123456' AS ingested_at, count(*) AS n
       FROM events WHERE event_id % 43 <> 0""",
)
def run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies without stamps get the run's, to the microsecond and in UTC."""
    from rawmart.__main__ import utc_text

    z = Zones(_scratch(spark, "run_stamps"))
    bodies = D.event_bodies(_events(spark, sf_dir)).drop("extract_run_id", "ingested_at")
    # one row for each day's response: the page number keeps them apart
    bodies = bodies.withColumn("indicator_id", F.concat("indicator_id", F.lit("_"), F.xxhash64("body").cast("string")))
    run_job(spark, z, bodies, None, _locations(spark, sf_dir), "run_0007", utc_text("2024-03-01T05:00:00.123456+02:00"))
    return spark.read.parquet(z.raw_indicator).groupBy("extract_run_id", "ingested_at").agg(F.count(F.lit(1)).alias("n"))


@register(
    "raw_append_runs",
    """SELECT 'run_' || strftime(ts, '%Y%m%d') AS extract_run_id, CAST(CAST(ts AS DATE) + 1 AS DATE) AS ingest_date, count(*) AS n
       FROM events WHERE event_id % 43 <> 0 GROUP BY 1, 2""",
)
def raw_append_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: runs append to the raw zone; the catalog's raw table holds the rows of all of them by ingest day."""
    z = Zones(_scratch(spark, "raw_append_runs"))
    for part in range(3):
        _run(spark, sf_dir, z, _events(spark, sf_dir, part, 3), f"run{part}", steps=[])
    return spark.table(z.table(f"raw/{X.RAW_INDICATOR_TABLE}")).groupBy("extract_run_id", S.RAW_PART).agg(F.count(F.lit(1)).alias("n"))


@register(
    "run_rejects",
    f"""WITH {_HOURLY.strip()},
body AS (SELECT location_id, source_variant, extract_run_id, bool_or(no_hourly OR short_precip OR no_wind) AS bad, max(loc_no) % 3 = 0 AS unknown
         FROM hb GROUP BY ALL)
SELECT 'dead_letter' AS sink, 'world_bank' AS source_name, 'invalid_indicator_record' AS reason, count(*) AS n
FROM events WHERE event_id % 43 = 0 HAVING count(*) > 0
UNION ALL
SELECT 'dead_letter', 'world_bank', 'bad_pages_value', count(DISTINCT (event_type, user_id // {D.USERS_PER_LOCATION}, CAST(ts AS DATE)))
FROM events WHERE (user_id // {D.USERS_PER_LOCATION}) % 7 = 0 AND day(ts) % 5 = 0 HAVING count(*) > 0
UNION ALL
SELECT 'dead_letter', 'open_meteo', CASE WHEN unknown THEN 'unknown_location' ELSE 'invalid_' || source_variant || '_payload' END AS r, count(*)
FROM body WHERE unknown OR bad GROUP BY r
UNION ALL
SELECT 'reject', 'open_meteo', 'bad_time', count(*)
FROM hrow WHERE body_valid AND timestamp IS NULL AND CAST(substr(location_id, 2) AS INTEGER) % 3 <> 0 HAVING count(*) > 0
UNION ALL
SELECT 'reject', 'world_bank', 'non_integer_year', count(*) FROM events WHERE event_id % 43 <> 0 AND event_id % 23 = 0 HAVING count(*) > 0""",
)
def run_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing vanishes in a run: broken pages, invalid records and payloads for locations that aren't
    configured are dead letters, bad times and years are rejects."""
    from rawmart.sources.landing import read_dead_letters

    z = Zones(_scratch(spark, "run_rejects"))
    known = _locations(spark, sf_dir).where(F.substring("location_id", 2, 6).cast("int") % 3 != 0)
    _run(spark, sf_dir, z, _events(spark, sf_dir), locations=known)
    sinks = {"dead_letter": read_dead_letters(spark, z.dead_letters), "reject": spark.read.schema("reason string, source_name string").json(z.rejects)}
    parts = [df.groupBy("source_name", "reason").agg(F.count(F.lit(1)).alias("n")).withColumn("sink", F.lit(name)) for name, df in sinks.items()]
    return parts[0].unionByName(parts[1]).select("sink", "source_name", "reason", "n")


@register("run_variants", f"WITH {_HOURLY}, m AS ({_latest_hourly_sql(chr(39).join(['source_variant = ', 'archive', '']))})\nSELECT location_id, timestamp, temperature_2m, precipitation, wind_speed_10m FROM m")
def run_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: a run with the forecast switched off."""
    z = Zones(_scratch(spark, "run_variants"))
    _run(spark, sf_dir, z, _events(spark, sf_dir), enabled_variants=("archive",))
    return spark.read.parquet(z.mart_hourly).select(*S.MART_HOURLY.fieldNames())


@register(
    "run_measures",
    f"""WITH {_HOURLY}
SELECT location_id, timestamp, temperature_2m FROM (
  SELECT *, row_number() OVER (PARTITION BY location_id, timestamp
            ORDER BY ingested_at DESC, extract_run_id DESC, (source_variant = 'archive') DESC, pos DESC) AS rn
  FROM hrow WHERE timestamp IS NOT NULL
) WHERE rn = 1""",
)
def run_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: a run of one measure; payloads that only lack others are then valid."""
    z = Zones(_scratch(spark, "run_measures"))
    _run(spark, sf_dir, z, _events(spark, sf_dir), measures=("temperature_2m",))
    return spark.read.parquet(z.mart_hourly).select("location_id", "timestamp", "temperature_2m")


@register(
    "run_named_steps",
    f"""{_HSTG}, {_EVENT_MART}
SELECT 'staging/stg_world_bank_indicator' AS folder, count(*) AS n FROM imart WHERE indicator_id IN ('click', 'view')
UNION ALL SELECT 'staging/stg_open_meteo_hourly', count(*) FROM hstg
UNION ALL SELECT 'mart/country_indicator_year', 0
UNION ALL SELECT 'mart/weather_hourly', count(*) FROM hstg""",
)
def run_named_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen indicators, and all steps but one: its mart stays empty."""
    z = Zones(_scratch(spark, "run_named_steps"))
    events = _events(spark, sf_dir)
    ids = events.where("event_type IN ('click', 'view')").select(F.concat_ws("_", "event_type", D.location_number().cast("string")).alias("indicator_id")).distinct()
    _run(spark, sf_dir, z, events, indicator_ids=ids, exclude=["mart_indicator"])
    names = [f"staging/{X.STG_INDICATOR_TABLE}", f"staging/{X.STG_HOURLY_TABLE}", f"mart/{X.MART_INDICATOR_TABLE}", f"mart/{X.MART_HOURLY_TABLE}"]
    out = None
    for folder in names:
        n = spark.table(z.table(folder)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(folder).alias("folder"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@register(
    "landing_dispositions",
    """SELECT d AS disposition, CASE WHEN d = 'append' THEN 2 * n ELSE n END AS n
       FROM (SELECT unnest(['append', 'overwrite', 'errorifexists']) AS d), (SELECT count(*) AS n FROM events)""",
)
def landing_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second landing in the same folder does: adds rows, replaces them, or fails and leaves them."""
    from pyspark.errors import AnalysisException

    from rawmart.sources.landing import land_jsonl

    records = D.indicator_records(D.table(spark, sf_dir, "events")).withColumn("extract_run_id", F.lit(D.RUN_ID))
    out = None
    for mode in ("append", "overwrite", "errorifexists"):
        path = _scratch(spark, "landing_dispositions")
        land_jsonl(records, path, one_run=True)
        try:
            land_jsonl(records, path, mode=mode, one_run=True)
        except AnalysisException:
            assert mode == "errorifexists"
        else:
            assert mode != "errorifexists"
        n = spark.read.schema("indicator_id string").json(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(mode).alias("disposition"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@register("upsert_existing", _STG_IND + "\nSELECT * FROM stg")
def upsert_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1/M3: several batches, older ones after newer ones, into a table that exists; the last batch comes twice."""
    from rawmart.operators.merge import merge_upsert

    path = _scratch(spark, "upsert_existing")
    raw = _raw_indicator(spark, sf_dir)
    for part in (2, 0, 1, 1):
        batch = zones.stg_indicator_source(raw.where(F.dayofmonth("ingested_at") % 3 == part), keep_order=True)
        merge_upsert(
            spark, path, zones.with_partition(batch, "indicator"), S.INDICATOR_KEYS, [S.INDICATOR_PART],
            ["country_iso3", "indicator_id"], recency=(zones.ORDER_COL,),
        )
    return spark.read.parquet(path).select(*S.STG_INDICATOR.fieldNames())
