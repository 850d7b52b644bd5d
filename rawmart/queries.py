"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's tables.

``ORACLE`` holds, per query, an independent DuckDB SQL that computes the same result straight from
the base tables (no JSON round trip), with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawmart import schemas as S
from rawmart.functions import (
    day_of,
    is_array,
    is_object,
    json_scalar,
    json_text,
    local_ts_to_utc,
    parse_once,
    safe_double,
    safe_long,
    truthy,
    year_bucket,
)
from rawmart.operators.cursors import last_time_cursor, max_year_cursor
from rawmart.operators.merge import merge_plan
from rawmart.plans import consume, zones
from rawmart.session import materialize
from rawmart.sources import driver_tables as D
from rawmart.sources.bodies import page_cut, unwrap_pages
from rawmart.sources.config_text import id_list, parse_locations, request_window

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- shared oracle fragments

# indicator records derived from events, typed, with their validity (the rules of driver_tables.indicator_record_json)
_IND_TYPED = """
ind AS (
  SELECT
    event_id,
    ts,
    event_type AS requested_id,
    'U' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS country_iso3,
    CASE WHEN event_id % 31 = 0 THEN NULL ELSE 'User ' || CAST(user_id AS VARCHAR) END AS country_name,
    CASE WHEN event_id % 29 = 0 THEN event_type || '_alt' ELSE event_type END AS indicator_id,
    'Indicator ' || event_type AS indicator_name,
    CASE WHEN event_id % 23 = 0 THEN CAST(2000 + hour(ts) AS VARCHAR) || 'Q1'
         ELSE CAST(2000 + hour(ts) AS VARCHAR) END AS date_text,
    CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(2000 + hour(ts) AS BIGINT) END AS year,
    CASE WHEN event_id % 19 = 0 OR event_id % 17 = 0 THEN NULL ELSE value END AS value_num,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) AS ingested_at,
    lpad(CAST(event_id AS VARCHAR), 10, '0') AS extract_run_id,
    NOT (event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 37 = 0
         OR (event_id % 23 <> 0 AND event_id % 53 <> 0 AND event_id % 47 = 0)) AS is_valid
  FROM events
)"""

_STG_IND = f"""
WITH {_IND_TYPED},
stg AS (
  SELECT country_iso3, country_name, indicator_id, indicator_name, year, value_num, ingested_at, extract_run_id
  FROM (
    SELECT *, row_number() OVER (PARTITION BY country_iso3, indicator_id, year
                                 ORDER BY ingested_at DESC, extract_run_id DESC) AS rn
    FROM ind WHERE is_valid AND year IS NOT NULL
  ) WHERE rn = 1
)"""


# ---------------------------------------------------------------- staging


def _raw_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, _ = zones.indicator_batch(D.indicator_records(D.table(spark, sf_dir, "events")))
    return raw


@register("stg_indicator_latest", _STG_IND + "\nSELECT * FROM stg")
def stg_indicator_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> indicator JSON records -> validity split -> typed projection -> latest per key."""
    return zones.stg_indicator_source(_raw_indicator(spark, sf_dir))



# ---------------------------------------------------------------- scalar JSON functions


def _events_json(spark: SparkSession, sf_dir: str, node: Column) -> DataFrame:
    """events + a JSON document ``{"n": <node>}`` parsed once (node NULL = key missing)."""
    ev = D.table(spark, sf_dir, "events")
    doc = F.concat(F.lit("{"), F.concat_ws(",", F.lit('"id":0'), F.concat(F.lit('"n":'), node)), F.lit("}"))
    return parse_once(ev.select("event_id", "user_id", "value", doc.alias("doc")), "doc", strict=True)


@register(
    "json_path_scalar",
    """SELECT event_id, json_extract_string(props, '$.k') AS k_text,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
       FROM events""",
)
def json_path_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = parse_once(D.table(spark, sf_dir, "events").select("event_id", "props"), "props", strict=True)
    return ev.select("event_id", json_scalar("payload", "$.k").alias("k_text")).select(
        "event_id", "k_text", safe_long("k_text").alias("k")
    )


_NODE_KINDS = """CASE event_id % 6 WHEN 0 THEN 'object' WHEN 1 THEN 'array' WHEN 2 THEN 'null'
                 WHEN 3 THEN 'missing' WHEN 4 THEN 'string' ELSE 'number' END"""


@register(
    "json_nonscalar_null",
    f"""SELECT event_id,
              CASE event_id % 6 WHEN 4 THEN 's' || CAST(user_id AS VARCHAR)
                                WHEN 5 THEN CAST(user_id AS VARCHAR) END AS node_text,
              event_id % 6 = 0 AS node_is_object,
              event_id % 6 = 1 AS node_is_array
       FROM events""",
)
def json_nonscalar_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    uid = F.col("user_id").cast("string")
    m = F.col("event_id") % 6
    node = (
        F.when(m == 0, F.concat(F.lit('{"a":'), uid, F.lit("}")))
        .when(m == 1, F.concat(F.lit("["), uid, F.lit("]")))
        .when(m == 2, F.lit("null"))
        .when(m == 4, F.concat(F.lit('"s'), uid, F.lit('"')))
        .when(m == 5, uid)
    )
    df = _events_json(spark, sf_dir, node)
    return df.select(
        "event_id",
        json_scalar("payload", "$.n").alias("node_text"),
        is_object("payload", "$.n").alias("node_is_object"),
        is_array("payload", "$.n").alias("node_is_array"),
    )


@register(
    "safe_casts",
    """SELECT event_id, txt AS cast_text,
              CASE WHEN m IN (0, 1, 2) THEN user_id
                   WHEN m = 4 THEN CAST(list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: CAST(c AS BIGINT)),
                                                    lambda a, b: a * 16 + b) AS BIGINT) END AS as_long,
              CASE WHEN m IN (0, 1, 2) THEN CAST(user_id AS DOUBLE)
                   WHEN m = 3 THEN user_id + 0.5
                   WHEN m = 6 THEN CAST(user_id * 100 AS DOUBLE)
                   WHEN m = 7 THEN value END AS as_double
       FROM (SELECT event_id, user_id, value, event_id % 8 AS m,
                    CASE event_id % 8 WHEN 0 THEN CAST(user_id AS VARCHAR)
                                      WHEN 1 THEN ' ' || CAST(user_id AS VARCHAR) || ' '
                                      WHEN 2 THEN '+' || CAST(user_id AS VARCHAR)
                                      WHEN 3 THEN CAST(user_id AS VARCHAR) || '.5'
                                      WHEN 4 THEN '0x' || CAST(user_id AS VARCHAR)
                                      WHEN 5 THEN ''
                                      WHEN 6 THEN CAST(user_id AS VARCHAR) || 'e2'
                                      ELSE CAST(value AS VARCHAR) END AS txt
             FROM events)""",
)
def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4/E5 on text shapes derived from events: integers with blanks/sign, decimals, hex, empty,
    exponents and the events' own decimal values."""
    ev = D.table(spark, sf_dir, "events")
    uid = F.col("user_id").cast("string")
    m = F.col("event_id") % 8
    txt = (
        F.when(m == 0, uid)
        .when(m == 1, F.concat(F.lit(" "), uid, F.lit(" ")))
        .when(m == 2, F.concat(F.lit("+"), uid))
        .when(m == 3, F.concat(uid, F.lit(".5")))
        .when(m == 4, F.concat(F.lit("0x"), uid))
        .when(m == 5, F.lit(""))
        .when(m == 6, F.concat(uid, F.lit("e2")))
        .otherwise(F.col("value").cast("string"))
    )
    df = ev.select("event_id", txt.alias("cast_text"))
    # the decimal text of a double: a whole number like 12.0 keeps its '.0', so it is not an integer
    return df.select("event_id", "cast_text", safe_long("cast_text").alias("as_long"), safe_double("cast_text").alias("as_double"))


@register(
    "truthy_filter",
    """SELECT event_id, event_id % 12 AS kind FROM events
       WHERE event_id % 12 IN (3, 7, 11) OR (event_id % 12 = 10 AND value <> 0)""",
)
def truthy_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Python truthiness of 12 JSON node shapes; keeps the truthy ones."""
    m = F.col("event_id") % 12
    node = (
        F.when(m == 0, F.lit("0"))
        .when(m == 1, F.lit("0.0"))
        .when(m == 2, F.lit('""'))
        .when(m == 3, F.lit('"0"'))
        .when(m == 4, F.lit("[]"))
        .when(m == 5, F.lit("{}"))
        .when(m == 6, F.lit("false"))
        .when(m == 7, F.lit("true"))
        .when(m == 8, F.lit("null"))
        .when(m == 10, F.col("value").cast("string"))
        .when(m == 11, F.lit('"x"'))
    )
    df = _events_json(spark, sf_dir, node)
    return df.where(truthy("payload", "$.n")).select("event_id", (F.col("event_id") % 12).alias("kind"))


# ---------------------------------------------------------------- time and buckets


@register(
    "parse_local_ts",
    f"""SELECT event_id,
              CASE WHEN event_id % 9 = 0 THEN NULL
                   ELSE timezone('UTC', timezone('{D.HOURLY_TZ}', date_trunc('minute', ts))) END AS utc_ts,
              CASE WHEN event_id % 9 = 0 THEN NULL
                   ELSE CAST(timezone('UTC', timezone('{D.HOURLY_TZ}', date_trunc('minute', ts))) AS DATE) END AS utc_date
       FROM events""",
)
def parse_local_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local wall-time text (every 9th with seconds, which the format rejects) -> UTC instant and day."""
    ev = D.table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 9 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    )
    utc = local_ts_to_utc(text, D.HOURLY_TZ)
    return ev.select("event_id", utc.alias("utc_ts")).select("event_id", "utc_ts", day_of("utc_ts").alias("utc_date"))


@register(
    "year_bucket",
    """SELECT o_orderkey, y AS year,
              CASE WHEN y < 1900 THEN 0 WHEN y >= 2200 THEN 301 ELSE y - 1899 END AS year_bucket
       FROM (SELECT o_orderkey, CAST(year(o_orderdate) + o_orderkey % 420 - 210 AS BIGINT) AS y FROM orders)""",
)
def year_bucket_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range buckets over 1900..2200 step 1 on order years shifted to span both edges."""
    o = D.table(spark, sf_dir, "orders")
    y = (F.year("o_orderdate") + F.col("o_orderkey") % 420 - 210).cast("bigint")
    return o.select("o_orderkey", y.alias("year")).select("o_orderkey", "year", year_bucket("year").alias("year_bucket"))


@register(
    "archive_window",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) - CAST(greatest(o_orderkey % 10 - 1, 0) AS INTEGER) AS start_date,
              CAST(o_orderdate AS DATE) AS end_date
       FROM orders""",
)
def archive_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive request window ending at the order date, 0..9 days long."""
    o = D.table(spark, sf_dir, "orders")
    start, end = request_window(F.to_date("o_orderdate"), (F.col("o_orderkey") % 10).cast("int"))
    return o.select("o_orderkey", start.alias("start_date"), end.alias("end_date"))


# ---------------------------------------------------------------- configuration text


@register(
    "id_list",
    """SELECT event_id, 0 AS pos, event_type AS id FROM events
       UNION ALL
       SELECT event_id, 1 AS pos, CAST(user_id AS VARCHAR) AS id FROM events""",
)
def id_list_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lists with blanks and empty entries -> trimmed ids."""
    ev = D.table(spark, sf_dir, "events")
    text = F.concat(F.lit(" "), F.col("event_type"), F.lit(" ,, "), F.col("user_id").cast("string"), F.lit(" , "))
    return ev.select("event_id", F.posexplode(id_list(text)).alias("pos", "id"))


_LOC_NO = f"(user_id // {D.USERS_PER_LOCATION})"
_LOC_ID = f"'L' || lpad(CAST({_LOC_NO} AS VARCHAR), 6, '0')"
_LOCATIONS = f"""(SELECT DISTINCT {_LOC_ID} AS location_id, CAST(40 + ({_LOC_NO} % 64) * 0.5 AS DOUBLE) AS latitude,
   CAST(-10 + ({_LOC_NO} % 64) * 1.25 AS DOUBLE) AS longitude FROM events)"""


# ---------------------------------------------------------------- paged bodies

_RUN = f"(o_orderkey // {D.RUN_ORDERS})"
_PAGE = f"CAST((o_orderkey % {D.RUN_ORDERS}) // {D.PAGE_SIZE} + 1 AS INTEGER)"
_PAGES = f"""
pg AS (
  SELECT DISTINCT o_orderpriority AS indicator_id, {_RUN} AS run, {_PAGE} AS page_no
  FROM orders
),
flags AS (
  SELECT indicator_id, run, page_no,
         run % {D.FAULTY_RUNS} = 0 AND ((indicator_id = '{D.EMPTY_PAGE[0]}' AND page_no = {D.EMPTY_PAGE[1]})
           OR (indicator_id = '{D.BAD_ENVELOPE_PAGE[0]}' AND page_no = {D.BAD_ENVELOPE_PAGE[1]})) AS is_empty,
         CASE WHEN run % {D.FAULTY_RUNS} <> 0 THEN 1000000
              WHEN indicator_id = '{D.NO_PAGES_INDICATOR}' THEN page_no
              WHEN indicator_id = '{D.TEXT_PAGES[0]}' THEN {D.TEXT_PAGES[1]}
              ELSE 1000000 END AS pages
  FROM pg
),
nonempty AS (
  -- a page whose every order key is a multiple of 13 would be empty too
  SELECT o_orderpriority AS indicator_id, {_RUN} AS run, {_PAGE} AS page_no
  FROM orders WHERE o_orderkey % 13 <> 0 GROUP BY 1, 2, 3
),
stops AS (
  SELECT f.indicator_id, f.run,
         min(CASE WHEN f.is_empty OR n.page_no IS NULL THEN f.page_no - 1
                  WHEN f.page_no >= f.pages THEN f.page_no END) AS stop_at
  FROM flags f LEFT JOIN nonempty n USING (indicator_id, run, page_no)
  GROUP BY f.indicator_id, f.run
),
gaps AS (
  SELECT indicator_id, run, min(c) - 1 AS gap_at FROM (
    SELECT indicator_id, run, page_no + 1 AS c FROM pg
    UNION SELECT DISTINCT indicator_id, run, 1 FROM pg
  ) cand
  WHERE NOT EXISTS (SELECT 1 FROM pg p WHERE p.indicator_id = cand.indicator_id AND p.run = cand.run AND p.page_no = cand.c)
  GROUP BY indicator_id, run
),
cut AS (
  SELECT g.indicator_id, g.run, least(g.gap_at, coalesce(s.stop_at, g.gap_at)) AS last_page
  FROM gaps g LEFT JOIN stops s USING (indicator_id, run)
)"""


@register("page_cut", f"WITH {_PAGES}\nSELECT 'run_' || lpad(CAST(run AS VARCHAR), 6, '0') AS extract_run_id, indicator_id, last_page FROM cut")
def page_cut_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last page kept per (run, indicator): empty page, pages reached (number or text),
    pages missing, and a bad envelope all end the page run."""
    return page_cut(D.indicator_bodies(D.table(spark, sf_dir, "orders")))


_UNWRAPPED = f"""
WITH {_PAGES},
rec AS (
  SELECT o.o_orderpriority AS indicator_id, {_PAGE} AS page_no,
         'C' || CAST(o.o_custkey AS VARCHAR) AS country_iso3, CAST(year(o.o_orderdate) AS VARCHAR) AS date_text,
         o.o_totalprice AS value_num, o.o_orderkey AS order_key
  FROM orders o JOIN cut c ON c.indicator_id = o.o_orderpriority AND c.run = {_RUN}
  WHERE o.o_orderkey % 13 <> 0 AND {_PAGE} <= c.last_page
)"""


@register("unwrap_pages", _UNWRAPPED + "\nSELECT * FROM rec")
def unwrap_pages_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages -> object records of the kept pages; non-objects dropped silently."""
    recs = unwrap_pages(D.indicator_bodies(D.table(spark, sf_dir, "orders")))
    return recs.select(
        "indicator_id",
        "page_no",
        json_scalar("payload", "$.countryiso3code").alias("country_iso3"),
        json_scalar("payload", "$.date").alias("date_text"),
        safe_double(json_scalar("payload", "$.value")).alias("value_num"),
        safe_long(json_scalar("payload", "$.order_key")).alias("order_key"),
    )


@register(
    "cursor_year",
    f"""WITH {_IND_TYPED.strip()}
       SELECT requested_id AS indicator_id, max(date_text) AS max_cursor_value
       FROM ind
       WHERE NOT (event_id % 23 <> 0 AND event_id % 53 <> 0 AND event_id % 47 = 0)
       GROUP BY requested_id""",
)
def cursor_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: text maximum of truthy ``date`` per requested indicator, over every record (valid or not)."""
    return max_year_cursor(D.indicator_records(D.table(spark, sf_dir, "events")))


# ---------------------------------------------------------------- indicator validity


@register(
    "indicator_valid",
    f"""WITH {_IND_TYPED.strip()}
       SELECT requested_id AS indicator_id, extract_run_id, ingested_at, '' AS source_file,
              country_iso3, date_text
       FROM ind WHERE is_valid""",
)
def indicator_valid_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_indicator(spark, sf_dir)
    return raw.select(
        "indicator_id",
        "extract_run_id",
        "ingested_at",
        "source_file",
        json_scalar("payload", "$.countryiso3code").alias("country_iso3"),
        json_scalar("payload", "$.date").alias("date_text"),
    )


@register(
    "indicator_dead",
    """SELECT 'world_bank' AS source_name, 'invalid_indicator_record' AS reason,
              lpad(CAST(event_id AS VARCHAR), 10, '0') AS extract_run_id,
              CAST(CAST(ts AS DATE) AS TIMESTAMP) AS ingested_at,
              event_type AS context_indicator_id,
              CASE WHEN event_id % 41 = 0 THEN 'empty_iso3' WHEN event_id % 43 = 0 THEN 'no_iso3'
                   WHEN event_id % 37 = 0 THEN 'country_text' ELSE 'date_zero' END AS fault
       FROM events
       WHERE event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 37 = 0
          OR (event_id % 23 <> 0 AND event_id % 53 <> 0 AND event_id % 47 = 0)""",
)
def indicator_dead_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dead = zones.indicator_batch(D.indicator_records(D.table(spark, sf_dir, "events")))
    p = "payload"
    fault = (
        F.when(json_scalar(p, "$.countryiso3code") == "", F.lit("empty_iso3"))
        .when(json_text(p, "$.countryiso3code").isNull(), F.lit("no_iso3"))
        .when(~is_object(p, "$.country"), F.lit("country_text"))
        .otherwise(F.lit("date_zero"))
    )
    return dead.select(
        "source_name",
        "reason",
        "extract_run_id",
        "ingested_at",
        F.col("context")["indicator_id"].alias("context_indicator_id"),
        fault.alias("fault"),
    )


@register(
    "indicator_rejects",
    f"""WITH {_IND_TYPED.strip()}
       SELECT 'non_integer_year' AS reason, country_iso3, indicator_id, date_text, ingested_at, extract_run_id
       FROM ind WHERE is_valid AND year IS NULL""",
)
def indicator_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid records that cannot reach staging (``2020Q1``-style dates), made visible."""
    return zones.stg_indicator_rejects(_raw_indicator(spark, sf_dir))


# ---------------------------------------------------------------- hourly path

_SPLIT = "2024-01-16"  # merge queries: rows landed before this day form one side, the rest the other

_HOURLY = f"""
hel AS (
  SELECT {_LOC_ID} AS location_id,
         CASE WHEN event_id % 2 = 0 THEN 'archive' ELSE 'forecast' END AS source_variant,
         CAST(ts AS DATE) AS day, CAST(floor(event_id / {D.HOURLY_BUCKET}) AS BIGINT) AS bucket,
         {_LOC_NO} AS loc_no, ts, event_id, value, user_id, props
  FROM events
),
hb AS (
  SELECT *,
         row_number() OVER (PARTITION BY location_id, source_variant, day, bucket ORDER BY ts) - 1 AS pos,
         count(*) OVER (PARTITION BY location_id, source_variant, day, bucket) AS n,
         (bucket + loc_no) % 17 = 0 AS no_hourly,
         (bucket + loc_no) % 13 = 0 AS short_precip,
         (bucket + loc_no) % 11 = 0 AS no_wind,
         strftime(day, '%Y%m%d') || '_' || lpad(CAST(bucket AS VARCHAR), 4, '0') AS extract_run_id,
         CAST(day + INTERVAL 1 DAY AS TIMESTAMP) AS ingested_at
  FROM hel
),
hrow AS (
  SELECT location_id, source_variant, extract_run_id, ingested_at, pos, ts, event_id, n,
         NOT (no_hourly OR short_precip OR no_wind) AS body_valid,
         CASE WHEN event_id % 41 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M') ELSE strftime(ts, '%Y-%m-%dT%H:00') END AS time_text,
         CASE WHEN event_id % 37 = 0 THEN NULL ELSE value END AS temperature_2m,
         CASE WHEN short_precip AND pos = n - 1 THEN NULL
              ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS precipitation,
         CASE WHEN no_wind OR event_id % 43 = 0 THEN NULL ELSE CAST(user_id % 40 AS DOUBLE) + 0.5 END AS wind_speed_10m,
         CASE WHEN event_id % 41 = 0 THEN NULL
              ELSE timezone('UTC', timezone('{D.HOURLY_TZ}', date_trunc('hour', ts))) END AS timestamp
  FROM hb
  WHERE NOT no_hourly AND event_id % 31 <> 0
),
loc AS {_LOCATIONS},
hstg_all AS (
  SELECT r.location_id, l.latitude, l.longitude, r.timestamp, r.temperature_2m, r.precipitation, r.wind_speed_10m,
         r.ingested_at, r.extract_run_id, r.source_variant, r.pos
  FROM hrow r JOIN loc l USING (location_id)
  WHERE r.body_valid AND r.timestamp IS NOT NULL
)"""


def _latest_hourly_sql(where: str = "TRUE") -> str:
    return f"""
  SELECT location_id, latitude, longitude, timestamp, temperature_2m, precipitation, wind_speed_10m, ingested_at, extract_run_id
  FROM (
    SELECT *, row_number() OVER (PARTITION BY location_id, timestamp
              ORDER BY ingested_at DESC, extract_run_id DESC, (source_variant = 'archive') DESC, pos DESC) AS rn
    FROM hstg_all WHERE {where}
  ) WHERE rn = 1"""


_HSTG = f"WITH {_HOURLY},\nhstg AS ({_latest_hourly_sql()})"


def _locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured locations parsed from configuration text, one for every USERS_PER_LOCATION users."""
    return parse_locations(D.table(spark, sf_dir, "events").select(D.location_spec().alias("spec")).distinct())


def _hourly_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    payloads = D.hourly_payloads(D.table(spark, sf_dir, "events"))
    return zones.hourly_batch(payloads, _locations(spark, sf_dir))


@register(
    "array_align",
    f"""WITH {_HOURLY}
       SELECT location_id, source_variant, extract_run_id, pos, time_text, temperature_2m, precipitation, wind_speed_10m
       FROM hrow""",
)
def array_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every captured payload (no validity gate) aligned by time offset; a short
    precipitation array and a missing wind array give NULLs; null times drop without shifting."""
    payloads = D.hourly_payloads(D.table(spark, sf_dir, "events"))
    rows = zones.hourly_rows(payloads.withColumn("latitude", F.lit(0.0)).withColumn("longitude", F.lit(0.0)), D.HOURLY_TZ)
    return rows.select(
        "location_id", "source_variant", "extract_run_id", "pos", "time_text", "temperature_2m", "precipitation", "wind_speed_10m"
    )


@register(
    "locations_parse",
    f"""SELECT loc.location_id, loc.latitude, loc.longitude, count(*) AS specs
       FROM events e JOIN {_LOCATIONS} loc ON loc.location_id = {_LOC_ID}
       GROUP BY 1, 2, 3""",
)
def locations_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One location text per event (``id:lat:lon`` with blank and empty entries around it) ->
    typed rows -> how many texts named each location."""
    ev = D.table(spark, sf_dir, "events")
    spec = F.concat(F.lit(" ; "), D.location_spec(), F.lit(" ;;"))
    locs = parse_locations(ev.select(spec.alias("spec")))
    return locs.groupBy("location_id", "latitude", "longitude").agg(F.count(F.lit(1)).alias("specs"))


_HBODY = f"""
WITH {_HOURLY},
body AS (
  SELECT location_id, source_variant, extract_run_id, ingested_at, count(*) AS n_times,
         bool_and(NOT (no_hourly OR short_precip OR no_wind)) AS body_valid
  FROM hb GROUP BY location_id, source_variant, extract_run_id, ingested_at
)"""


@register(
    "hourly_valid",
    _HBODY
    + """
SELECT b.location_id, l.latitude, l.longitude, b.source_variant, b.extract_run_id, b.ingested_at, b.n_times
FROM body b JOIN loc l USING (location_id) WHERE b.body_valid""",
)
def hourly_valid_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid payloads with configured coordinates."""
    raw, _ = _hourly_batch(spark, sf_dir)
    return raw.select(
        "location_id",
        "latitude",
        "longitude",
        "source_variant",
        "extract_run_id",
        "ingested_at",
        F.size(F.try_variant_get("payload", "$.hourly.time", "array<variant>")).cast("bigint").alias("n_times"),
    )


@register(
    "hourly_dead",
    _HBODY
    + """
SELECT 'open_meteo' AS source_name, 'invalid_' || source_variant || '_payload' AS reason,
       extract_run_id, ingested_at, location_id AS context_location_id
FROM body WHERE NOT body_valid""",
)
def hourly_dead_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads failing the shape gate -> dead letters with the variant in the reason."""
    _, dead = _hourly_batch(spark, sf_dir)
    return dead.select(
        "source_name", "reason", "extract_run_id", "ingested_at", F.col("context")["location_id"].alias("context_location_id")
    )


@register(
    "cursor_last_time",
    f"""WITH {_HOURLY}
       SELECT location_id, source_variant, extract_run_id,
              CASE WHEN no_hourly OR event_id % 31 = 0 THEN NULL
                   WHEN event_id % 41 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M')
                   ELSE strftime(ts, '%Y-%m-%dT%H:00') END AS last_time
       FROM hb WHERE pos = n - 1""",
)
def cursor_last_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last element of ``hourly.time`` per payload (not the maximum)."""
    payloads = D.hourly_payloads(D.table(spark, sf_dir, "events"))
    return payloads.select("location_id", "source_variant", "extract_run_id", last_time_cursor("payload").alias("last_time"))


def _stg_hourly(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    raw, _ = _hourly_batch(spark, sf_dir)
    if where is not None:
        raw = raw.where(where)
    return zones.stg_hourly_source(raw, D.HOURLY_TZ)


@register("stg_hourly_latest", _HSTG + "\nSELECT * FROM hstg")
def stg_hourly_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid payloads -> aligned rows -> local hour to UTC -> latest per (location, hour)."""
    return _stg_hourly(spark, sf_dir)


@register(
    "hourly_rejects",
    f"""WITH {_HOURLY}
       SELECT 'bad_time' AS reason, location_id, time_text, pos, ingested_at, extract_run_id
       FROM hrow WHERE body_valid AND timestamp IS NULL""",
)
def hourly_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time elements that are present but not local ``yyyy-MM-ddTHH:mm`` go to rejects, not staging."""
    raw, _ = _hourly_batch(spark, sf_dir)
    return zones.stg_hourly_rejects(raw, D.HOURLY_TZ)


# ---------------------------------------------------------------- merge

_IND_SIDES = f"""
WITH {_IND_TYPED.strip()},
side AS (
  SELECT *, ts < TIMESTAMP '{_SPLIT}' AS early FROM ind WHERE is_valid AND year IS NOT NULL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY early, country_iso3, indicator_id, year
                               ORDER BY ingested_at DESC, extract_run_id DESC) AS rn
  FROM side
),
t AS (SELECT country_iso3, country_name, indicator_id, indicator_name, year, value_num, ingested_at, extract_run_id
      FROM ranked WHERE rn = 1 AND NOT early),
s AS (SELECT country_iso3, country_name, indicator_id, indicator_name, year, value_num, ingested_at, extract_run_id
      FROM ranked WHERE rn = 1 AND early)
SELECT * FROM t WHERE NOT EXISTS (
  SELECT 1 FROM s WHERE s.country_iso3 = t.country_iso3 AND s.indicator_id = t.indicator_id AND s.year = t.year)
UNION ALL SELECT * FROM s"""


def _ind_sides(spark: SparkSession, sf_dir: str, keep_order: bool = False) -> tuple[DataFrame, DataFrame]:
    raw = _raw_indicator(spark, sf_dir)
    early = F.col("ingested_at") < F.lit(_SPLIT).cast("timestamp_ntz")
    late_stg = zones.stg_indicator_source(raw.where(~early), keep_order)
    early_stg = zones.stg_indicator_source(raw.where(early), keep_order)
    return late_stg, early_stg


@register("merge_indicator", _IND_SIDES)
def merge_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """target = staging of the later days, source = staging of the earlier days, no recency
    guard: every matched row is replaced by the (older) source row, unmatched target rows stay."""
    target, source = _ind_sides(spark, sf_dir)
    return merge_plan(target, source, S.INDICATOR_KEYS)


@register("merge_twice", _IND_SIDES)
def merge_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: merging the same source twice gives the same table as merging it once."""
    target, source = _ind_sides(spark, sf_dir)
    once = merge_plan(target, source, S.INDICATOR_KEYS)
    return merge_plan(once, source, S.INDICATOR_KEYS)


@register("merge_guarded", _STG_IND + "\nSELECT * FROM stg")
def merge_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the recency guard an older source never overwrites; the result equals staging of all rows."""
    # the merge reads each side more than once; staging is a written table
    target, source = (materialize(side, "merge_side") for side in _ind_sides(spark, sf_dir, keep_order=True))
    merged = merge_plan(target, source, S.INDICATOR_KEYS, recency=[zones.ORDER_COL])
    return merged.select(*S.STG_INDICATOR.fieldNames())


@register(
    "merge_hourly",
    f"""WITH {_HOURLY},
t AS ({_latest_hourly_sql(f"ingested_at >= TIMESTAMP '{_SPLIT}'")}),
s AS ({_latest_hourly_sql(f"ingested_at < TIMESTAMP '{_SPLIT}'")})
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.location_id = t.location_id AND s.timestamp = t.timestamp)
UNION ALL SELECT * FROM s""",
)
def merge_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1/J7 on the hourly staging key (location, timestamp)."""
    early = F.col("ingested_at") < F.lit(_SPLIT).cast("timestamp_ntz")
    target = _stg_hourly(spark, sf_dir, ~early)
    source = _stg_hourly(spark, sf_dir, early)
    return merge_plan(target, source, S.HOURLY_KEYS)


# ---------------------------------------------------------------- marts and consumers


@register(
    "mart_indicator_year",
    _STG_IND + "\nSELECT country_iso3, country_name, indicator_id, indicator_name, year, value_num FROM stg",
)
def mart_indicator_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.mart_indicator_source(zones.stg_indicator_source(_raw_indicator(spark, sf_dir)))


_MART_H = _HSTG + ",\nmart AS (SELECT location_id, timestamp, temperature_2m, precipitation, wind_speed_10m FROM hstg)"


@register("mart_hourly", _MART_H + "\nSELECT * FROM mart")
def mart_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: captured hourly bodies -> validity split -> aligned, typed rows -> staging -> mart."""
    return zones.mart_hourly_source(_stg_hourly(spark, sf_dir))


@register(
    "kpi_latest",
    _STG_IND
    + """
SELECT country_iso3, indicator_id, year, value_num FROM (
  SELECT *, row_number() OVER (PARTITION BY country_iso3, indicator_id ORDER BY year DESC) AS rn
  FROM stg WHERE value_num IS NOT NULL) WHERE rn = 1""",
)
def kpi_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest known value per country and indicator."""
    return consume.latest_value(mart_indicator_year(spark, sf_dir))


@register("annual_series", _STG_IND + "\nSELECT country_iso3, indicator_id, year, value_num FROM stg")
def annual_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly series (no filter: every country and indicator)."""
    return consume.annual_series(mart_indicator_year(spark, sf_dir))


@register("hourly_series", _MART_H + "\nSELECT * FROM mart")
def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly series over every location and the whole time range."""
    return consume.hourly_series(mart_hourly(spark, sf_dir))


@register(
    "chart_feed",
    _MART_H
    + """
SELECT location_id, timestamp, 'temperature_2m' AS measure, temperature_2m AS value FROM mart
UNION ALL SELECT location_id, timestamp, 'precipitation', precipitation FROM mart
UNION ALL SELECT location_id, timestamp, 'wind_speed_10m', wind_speed_10m FROM mart""",
)
def chart_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: long form per measure for the three charts."""
    return consume.chart_feed(mart_hourly(spark, sf_dir))


_AS_OF = "2024-01-31 12:00:00"


@register(
    "freshness",
    f"""WITH {_IND_TYPED.strip()}, {_HOURLY},
last AS (
  SELECT 'world_bank' AS source, max(ingested_at) AS last_ingested_at FROM ind WHERE is_valid
  UNION ALL
  SELECT 'open_meteo', max(ingested_at) FROM hb WHERE NOT (no_hourly OR short_precip OR no_wind)
)
SELECT source, last_ingested_at,
       (epoch_us(TIMESTAMP '{_AS_OF}') - epoch_us(last_ingested_at)) / 3.6e9 AS age_hours,
       last_ingested_at IS NULL OR (epoch_us(TIMESTAMP '{_AS_OF}') - epoch_us(last_ingested_at)) / 3.6e9 > 24 AS is_stale
FROM last""",
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last landing per source against an as-of time with a 24 h limit."""
    raw_h, _ = _hourly_batch(spark, sf_dir)
    return consume.freshness({"world_bank": _raw_indicator(spark, sf_dir), "open_meteo": raw_h}, _AS_OF, 24)


@register(
    "reject_summary",
    f"""WITH {_IND_TYPED.strip()}, {_HOURLY.strip()},
body AS (SELECT DISTINCT location_id, source_variant, extract_run_id, (no_hourly OR short_precip OR no_wind) AS bad FROM hb)
SELECT 'world_bank' AS source_name, 'invalid_indicator_record' AS reason, count(*) AS rejected FROM ind WHERE NOT is_valid
UNION ALL
SELECT 'open_meteo', 'invalid_' || source_variant || '_payload', count(*) FROM body WHERE bad GROUP BY source_variant""",
)
def reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of both sources counted by reason."""
    _, dead_i = zones.indicator_batch(D.indicator_records(D.table(spark, sf_dir, "events")))
    _, dead_h = _hourly_batch(spark, sf_dir)
    return consume.reject_summary(dead_i.unionByName(dead_h))


@register(
    "run_metrics",
    f"""WITH {_IND_TYPED.strip()}, {_HOURLY.strip()},
body AS (SELECT DISTINCT location_id, source_variant, extract_run_id, (no_hourly OR short_precip OR no_wind) AS bad FROM hb)
SELECT 'world_bank' AS source_name, requested_id AS entity, count(*) AS records FROM ind WHERE is_valid GROUP BY requested_id
UNION ALL
SELECT 'open_meteo', location_id, count(*) FROM body WHERE NOT bad GROUP BY location_id""",
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid records per indicator and valid payloads per location."""
    from rawmart.operators.cursors import run_metrics as metrics

    raw_i = _raw_indicator(spark, sf_dir).select(F.lit("world_bank").alias("source_name"), F.col("indicator_id").alias("entity"))
    raw_h, _ = _hourly_batch(spark, sf_dir)
    raw_h = raw_h.select(F.lit("open_meteo").alias("source_name"), F.col("location_id").alias("entity"))
    return metrics(raw_i.unionByName(raw_h), ["source_name", "entity"])



# ---------------------------------------------------------------- landing, raw zone, dead letters

_LANDED_AT = "2024-02-01T00:00:00+00:00"
_LANDING_FILE = "world_bank_indicator_run_0001_2024-02-01T00-00-00+00-00.jsonl"


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp folder)."""
    import uuid

    from rawmart.session import delete_at_exit, scratch_path

    return delete_at_exit(spark, scratch_path(spark, f"queries/{name}/{uuid.uuid4().hex}"))


@register(
    "raw_roundtrip",
    f"""WITH {_IND_TYPED.strip()}
       SELECT requested_id AS indicator_id, 'run_0001' AS extract_run_id, ingested_at,
              '{_LANDING_FILE}' AS source_file, country_iso3, date_text
       FROM ind WHERE is_valid""",
)
def raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid raw rows of one run -> newline JSON in ``extract_run_id=`` folders
    (nulls written, payload as nested JSON) -> read back with the fixed raw schema."""
    from rawmart.sources.landing import land_jsonl, landing_name, read_landed

    raw = _raw_indicator(spark, sf_dir).withColumn("extract_run_id", F.lit(D.RUN_ID))
    path = _scratch(spark, "raw_roundtrip")
    land_jsonl(raw, path, source_file=landing_name("world_bank_indicator", D.RUN_ID, _LANDED_AT))
    back = read_landed(spark, path, S.RAW_INDICATOR, corrupt_column=None)
    return back.select(
        "indicator_id",
        "extract_run_id",
        "ingested_at",
        "source_file",
        json_scalar("payload", "$.countryiso3code").alias("country_iso3"),
        json_scalar("payload", "$.date").alias("date_text"),
    )


@register(
    "drift_read",
    """SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_type END AS indicator_id,
              CASE WHEN event_id % 50 = 0 OR event_id % 7 = 0 THEN NULL ELSE 'f' || CAST(event_id % 3 AS VARCHAR) END AS source_file,
              CASE WHEN event_id % 50 = 0 THEN NULL ELSE event_id END AS payload_id,
              CASE WHEN event_id % 50 = 0 THEN 'not json ' || CAST(event_id AS VARCHAR) END AS corrupt_line
       FROM events""",
)
def drift_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: landed lines with an extra top-level field (ignored), a missing field (NULL), drift inside
    the payload (kept by VARIANT) and broken lines (kept in the corrupt column, no failure)."""
    from rawmart.sources.landing import read_landed

    ev = D.table(spark, sf_dir, "events")
    eid = F.col("event_id").cast("string")
    src = F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit('"f'), (F.col("event_id") % 3).cast("string"), F.lit('"')))
    line = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("not json "), eid)).otherwise(
        F.concat(
            F.lit('{"indicator_id":"'), F.col("event_type"), F.lit('","unexpected":'), eid,
            F.lit(',"payload":{"id":'), eid, F.lit(',"new_field":[1,2]}'),
            F.when(src.isNotNull(), F.concat(F.lit(',"source_file":'), src)).otherwise(F.lit("")),
            F.lit("}"),
        )
    )
    path = _scratch(spark, "drift_read")
    ev.select(line.alias("value")).write.text(path)
    back = read_landed(spark, path, S.RAW_INDICATOR)
    return back.select(
        "indicator_id",
        "source_file",
        safe_long(json_scalar("payload", "$.id")).alias("payload_id"),
        F.col("_corrupt").alias("corrupt_line"),
    )


@register(
    "dead_letter_sink",
    f"""WITH {_IND_TYPED.strip()}, {_HOURLY.strip()},
body AS (SELECT DISTINCT location_id, source_variant, extract_run_id, (no_hourly OR short_precip OR no_wind) AS bad FROM hb)
SELECT 'world_bank' AS source_name, 'invalid_indicator_record' AS reason, count(*) AS rejected,
       count(DISTINCT ingested_at) AS runs FROM ind WHERE NOT is_valid
UNION ALL
SELECT 'open_meteo', 'invalid_' || source_variant || '_payload', count(*), count(DISTINCT left(extract_run_id, 8))
FROM body WHERE bad GROUP BY source_variant""",
)
def dead_letter_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of both sources -> JSONL sink (one folder per source and run) -> read back."""
    from rawmart.sources.landing import read_dead_letters, write_dead_letters

    _, dead_i = zones.indicator_batch(D.indicator_records(D.table(spark, sf_dir, "events")))
    _, dead_h = _hourly_batch(spark, sf_dir)
    path = _scratch(spark, "dead_letter_sink")
    # one run a day, as a scheduled job has it
    daily = dead_i.unionByName(dead_h).withColumn("extract_run_id", F.date_format("ingested_at", "yyyyMMdd"))
    write_dead_letters(daily, path)
    back = read_dead_letters(spark, path)
    return back.groupBy("source_name", "reason").agg(
        F.count(F.lit(1)).alias("rejected"), F.countDistinct("extract_run_id").alias("runs")
    )


# ---------------------------------------------------------------- streaming


@register("stream_merge", _STG_IND + "\nSELECT * FROM stg")
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows landed as several files -> availableNow file stream -> foreachBatch upsert with the
    recency guard into a partitioned staging table; the table equals staging over all rows."""
    from rawmart.sources.landing import land_jsonl
    from rawmart.streaming import stream_upsert

    base = _scratch(spark, "stream_merge")
    raw = _raw_indicator(spark, sf_dir)
    # newest rows first in file order, so later micro-batches bring older rows the guard must refuse
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    land_jsonl(raw.repartitionByRange(files, F.col("ingested_at").desc()), f"{base}/landing", by_run=False)
    stream_upsert(
        spark,
        f"{base}/landing",
        S.RAW_INDICATOR,
        lambda b: zones.stg_indicator_source(b, keep_order=True),
        f"{base}/stg",
        S.INDICATOR_KEYS,
        [S.INDICATOR_PART],
        lambda df: zones.with_partition(df, "indicator"),
        f"{base}/_checkpoint",
        max_files_per_trigger=max(1, files // 4),
    )
    return spark.read.parquet(f"{base}/stg").select(*S.STG_INDICATOR.fieldNames())


# ---------------------------------------------------------------- one run end to end


@register("full_run", _MART_H + "\nSELECT * FROM mart")
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: both sources built, landed (dead letters, landing JSONL, raw zone), then staging and mart
    upserts in order; the result is the weather mart read back from its partitioned table."""
    from rawmart.plans.job import Zones, run_job

    z = Zones(_scratch(spark, "full_run"))
    run_job(
        spark,
        z,
        D.indicator_bodies(D.table(spark, sf_dir, "orders")),
        D.hourly_bodies(D.table(spark, sf_dir, "events")),
        _locations(spark, sf_dir),
        run_id=None,
        ingested_at=None,
        tz=D.HOURLY_TZ,
    )
    return spark.read.parquet(z.mart_hourly).select(*S.MART_HOURLY.fieldNames())


@register(
    "request_params",
    f"""SELECT DISTINCT l.location_id, l.latitude, l.longitude,
              'temperature_2m,precipitation,wind_speed_10m' AS hourly, '{D.HOURLY_TZ}' AS timezone,
              strftime(CAST(e.ts AS DATE) - 6, '%Y-%m-%d') AS start_date, strftime(CAST(e.ts AS DATE), '%Y-%m-%d') AS end_date
       FROM events e JOIN {_LOCATIONS} l ON l.location_id = {_LOC_ID}""",
)
def request_params_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 7-day archive request per location and event day, variables comma-joined
    from the configured list."""
    from rawmart.sources.config_text import request_params

    ev = D.table(spark, sf_dir, "events").select(D.location_of_user().alias("location_id"), F.to_date("ts").alias("day"))
    located = ev.distinct().join(_locations(spark, sf_dir), "location_id")
    variables = id_list(F.lit(" temperature_2m, precipitation ,,wind_speed_10m "))
    return request_params(located, variables, D.HOURLY_TZ, F.col("day"), 7).drop("day").distinct()


@register("incremental_merge", _STG_IND + "\nSELECT * FROM stg")
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging holds the early days; only raw rows of runs that it has not seen are staged and
    merged with the recency guard; the result equals staging over everything."""
    from rawmart.operators.cursors import unseen_runs

    raw = materialize(_raw_indicator(spark, sf_dir), "raw")  # raw and staging are written tables, each read more than once
    early = F.col("ingested_at") < F.lit(_SPLIT).cast("timestamp_ntz")
    target = materialize(zones.stg_indicator_source(raw.where(early), keep_order=True), "staging")
    fresh = unseen_runs(raw, raw.where(early))
    source = materialize(zones.stg_indicator_source(fresh, keep_order=True), "staged")
    merged = merge_plan(target, source, S.INDICATOR_KEYS, recency=[zones.ORDER_COL])
    return merged.select(*S.STG_INDICATOR.fieldNames())


@register(
    "day_bucket",
    """SELECT event_id, CAST(ts AS DATE) AS event_date,
              CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS half
       FROM events""",
)
def day_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTC calendar day of each instant (the hourly tables' partition column)."""
    ev = D.table(spark, sf_dir, "events")
    half = F.when(F.col("ts") < F.lit(_SPLIT).cast("timestamp_ntz"), 0).otherwise(1)
    return ev.select("event_id", day_of("ts").alias("event_date"), half.alias("half"))


@register(
    "array_null_time",
    f"""WITH {_HOURLY}
       SELECT location_id, source_variant, extract_run_id,
              count(*) AS n_times,
              count(*) FILTER (WHERE event_id % 31 <> 0) AS n_rows,
              max(CASE WHEN event_id % 31 <> 0 THEN pos END) AS last_pos
       FROM hb WHERE NOT no_hourly
       GROUP BY location_id, source_variant, extract_run_id""",
)
def array_null_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null time elements are dropped after the offset is taken, so kept rows keep their
    positions: per payload, array length vs rows produced and the last kept offset."""
    payloads = D.hourly_payloads(D.table(spark, sf_dir, "events"))
    sizes = payloads.select(
        "location_id", "source_variant", "extract_run_id",
        F.size(F.try_variant_get("payload", "$.hourly.time", "array<variant>")).cast("bigint").alias("n_times"),
    ).where(F.col("n_times") >= 0)
    aligned = zones.hourly_rows(payloads.withColumn("latitude", F.lit(0.0)).withColumn("longitude", F.lit(0.0)), D.HOURLY_TZ)
    per_body = aligned.groupBy("location_id", "source_variant", "extract_run_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("pos").alias("last_pos")
    )
    keys = ["location_id", "source_variant", "extract_run_id"]
    # both sides have a row for each body; the size Spark guesses for an aggregate over exploded JSON is far too small to broadcast by
    return sizes.join(per_body.hint("merge"), keys, "left").select(
        *keys, "n_times", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "last_pos"
    )


def _stream_hourly(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Archive payloads land first, forecast payloads later; the stream keeps raw, staging and mart below the returned folder."""
    from rawmart.sources.landing import land_jsonl
    from rawmart.streaming import stream_upsert

    base = _scratch(spark, name)
    raw, _ = _hourly_batch(spark, sf_dir)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a guard on (ingested_at, run) alone would let the later forecast batch win the ties the batch rule gives to archive
    for variant in ("archive", "forecast"):
        land_jsonl(raw.where(F.col("source_variant") == variant).repartition(files), f"{base}/landing", by_run=False)
    stream_upsert(
        spark,
        f"{base}/landing",
        S.RAW_HOURLY,
        lambda b: zones.stg_hourly_source(b, D.HOURLY_TZ, keep_order=True),
        f"{base}/stg",
        S.HOURLY_KEYS,
        [S.HOURLY_PART],
        lambda df: zones.with_partition(df, "hourly"),
        f"{base}/_checkpoint",
        max_files_per_trigger=files,
        cluster_by=["location_id"],
        raw_path=f"{base}/raw",
        raw_part=zones.with_ingest_date,
        mart_path=f"{base}/mart",
        to_mart=zones.mart_hourly_source,
    )
    return base


@register("stream_merge_hourly", _HSTG + "\nSELECT * FROM hstg")
def stream_merge_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 on the hourly path: archive and forecast rows of one run arrive in different micro-batches; the staging
    order key kept in the table settles them as one batch would."""
    base = _stream_hourly(spark, sf_dir, "stream_merge_hourly")
    return spark.read.parquet(f"{base}/stg").select(*S.STG_HOURLY.fieldNames())


@register("stream_mart", _MART_H + "\nSELECT * FROM mart")
def stream_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart that the stream refreshes after each micro-batch, of the staging partitions the batch touched."""
    base = _stream_hourly(spark, sf_dir, "stream_mart")
    return spark.read.parquet(f"{base}/mart").select(*S.MART_HOURLY.fieldNames())


FLAGSHIP = "mart_hourly"

from rawmart import run_queries, version_queries  # noqa: E402, F401  register the queries over whole runs and versioned tables
