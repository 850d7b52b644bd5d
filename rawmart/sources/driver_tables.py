"""Captured API bodies derived from the driver's tables, so every query's work grows with them.

The driver gives TPC-H-like tables plus ``events``; the engine's inputs are captured JSON bodies.
These functions turn table rows into such bodies with Spark (nothing is written, nothing goes
through the driver). Faults are injected by fixed rules on row ids, so an independent SQL oracle
can compute the expected result straight from the base tables.

Grouping into bodies is always bounded: an hourly body holds at most ``HOURLY_BUCKET`` events and
a page at most ``PAGE_SIZE`` orders, whatever the skew of users or priorities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawmart.functions import parse_once
from rawmart.session import bytes_below

# Fixed values of the derivation (the oracle SQL repeats them).
PAGE_SIZE = 100  # orders per captured page: page_no = (o_orderkey mod 5000) div 100 + 1
HOURLY_BUCKET = 1600  # events per hourly bucket: body = (location, variant, day, event_id div 1600)
USERS_PER_LOCATION = 4  # location_id = 'L' || lpad(user_id div 4, 6, '0'): locations grow with the users
RUN_ORDERS = 5000  # order keys of one captured run: up to 50 pages for each priority
FAULTY_RUNS = 4  # every fourth run has the page faults below, so a fixed share of the pages is cut
HOURLY_TZ = "America/New_York"  # local wall time of the hourly payloads
EMPTY_PAGE = ("3-MEDIUM", 40)  # all records non-objects -> stop before this page
BAD_ENVELOPE_PAGE = ("2-HIGH", 30)  # body is an object, not [metadata, records]
NO_PAGES_INDICATOR = "4-NOT SPECIFIED"  # metadata without "pages" -> stop after page 1
TEXT_PAGES = ("5-LOW", "25")  # "pages" given as text
TASK_BYTES = 8 << 20  # a driver table's stored bytes for one task: its rows become JSON text of many times that size
SHUFFLE_BYTES = 2 << 20  # and for one task after a shuffle, which sorts and joins those rows
RUN_ID = "run_0001"  # of the queries that land one run
RUN_TS = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Unless it has a file for each task, it is spread round-robin over the cluster's cores, or over one task for
    each ``TASK_BYTES`` if that is more: the per-row JSON work then uses every core, and a task's share of it doesn't grow with the
    table. (Splits can't tell: a file with one row group is one task's work, however many splits it is cut into.) The shuffle
    moves the stored columns only. The session's shuffle partitions are raised to one for each ``SHUFFLE_BYTES``, so the
    memory of a task that sorts or joins the derived rows doesn't grow either."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    stored = bytes_below(spark, path)
    if -(-stored // SHUFFLE_BYTES) > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(-(-stored // SHUFFLE_BYTES)))
    tasks = max(spark.sparkContext.defaultParallelism, -(-stored // TASK_BYTES))
    if len(df.inputFiles()) < tasks:
        df = df.repartition(tasks)
    return df


def _q(c: Column) -> Column:
    """JSON string literal for ids and words (the derived values contain no quotes or backslashes)."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def _obj(*pairs: tuple[str, Column | None]) -> Column:
    """JSON object text from (key, json-text) pairs; a NULL text drops the key."""
    parts = [F.concat(F.lit(f'"{k}":'), v) for k, v in pairs]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _mod(n: int) -> Column:
    return F.col("event_id") % n == 0


# ---------------------------------------------------------------- indicator records (events)


def indicator_record_json(events: DataFrame) -> DataFrame:
    """One indicator record per event: ``indicator_id, ingested_at, extract_run_id, payload_json``.

    country <- user, indicator <- event_type, date <- 2000 + hour(ts), value <- value;
    ingested_at <- day of ts, run id <- zero-padded event_id. Faults by event_id:
    %41 iso3 "" | %43 iso3 missing | %37 country is text | %31 country.value is an object |
    %29 indicator.id differs from the requested id | %23 date "yyyyQ1" | %53 date is a number |
    %47 date is 0 | %19 value null | %17 value "n/a" | %13 value as text.
    """
    year = (F.hour("ts") + 2000).cast("string")
    iso3 = F.when(_mod(41), F.lit('""')).when(_mod(43), F.lit(None)).otherwise(
        _q(F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 5, "0")))
    )
    country = (
        F.when(_mod(37), F.lit('"N/A"'))
        .when(_mod(31), F.lit('{"id":"X","value":{"x":1}}'))
        .otherwise(_obj(("id", F.lit('"X"')), ("value", _q(F.concat(F.lit("User "), F.col("user_id").cast("string"))))))
    )
    ind_id = F.when(_mod(29), F.concat(F.col("event_type"), F.lit("_alt"))).otherwise(F.col("event_type"))
    indicator = _obj(("id", _q(ind_id)), ("value", _q(F.concat(F.lit("Indicator "), F.col("event_type")))))
    date = (
        F.when(_mod(23), _q(F.concat(year, F.lit("Q1"))))
        .when(_mod(53), year)
        .when(_mod(47), F.lit("0"))
        .otherwise(_q(year))
    )
    value_text = F.col("value").cast("string")
    value = (
        F.when(_mod(19), F.lit("null"))
        .when(_mod(17), F.lit('"n/a"'))
        .when(_mod(13), _q(value_text))
        .otherwise(value_text)
    )
    payload = _obj(
        ("countryiso3code", iso3), ("country", country), ("indicator", indicator), ("date", date), ("value", value)
    )
    return events.select(
        F.col("event_type").alias("indicator_id"),
        F.to_date("ts").cast("timestamp_ntz").alias("ingested_at"),
        F.lpad(F.col("event_id").cast("string"), 10, "0").alias("extract_run_id"),
        payload.alias("payload_json"),
    )


def indicator_records(events: DataFrame) -> DataFrame:
    """As ``indicator_record_json`` with the payload parsed to VARIANT."""
    return parse_once(indicator_record_json(events), "payload_json", strict=True)


# ---------------------------------------------------------------- paged bodies (orders)


def _run_number() -> Column:
    return F.floor(F.col("o_orderkey") / RUN_ORDERS)


def _page() -> Column:
    return (F.floor((F.col("o_orderkey") % RUN_ORDERS) / PAGE_SIZE) + 1).cast("int")


def _faulty() -> Column:
    return _run_number() % FAULTY_RUNS == 0


def order_record_json(orders: DataFrame) -> Column:
    """One record per order; every 13th order key is a bare number (a non-object record)."""
    key = F.col("o_orderkey").cast("string")
    rec = _obj(
        ("countryiso3code", _q(F.concat(F.lit("C"), F.col("o_custkey").cast("string")))),
        ("country", _obj(("value", _q(F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")))))),
        ("indicator", _obj(("id", _q(F.col("o_orderpriority"))), ("value", _q(F.col("o_orderstatus"))))),
        ("date", _q(F.year("o_orderdate").cast("string"))),
        ("value", F.col("o_totalprice").cast("string")),
        ("order_key", key),
    )
    empty = (F.col("o_orderpriority") == EMPTY_PAGE[0]) & (_page() == EMPTY_PAGE[1]) & _faulty()
    return F.when((F.col("o_orderkey") % 13 == 0) | empty, key).otherwise(rec)


def indicator_bodies(orders: DataFrame) -> DataFrame:
    """Captured paged responses: ``indicator_id, page_no, body, extract_run_id, ingested_at``.

    indicator <- o_orderpriority, run <- o_orderkey div RUN_ORDERS, page <- (o_orderkey mod RUN_ORDERS) div PAGE_SIZE + 1
    (so at most PAGE_SIZE records per body). The faults of the module constants are in every FAULTY_RUNS-th run.
    """
    recs = orders.select(
        F.col("o_orderpriority").alias("indicator_id"),
        _run_number().alias("run"),
        _page().alias("page_no"),
        F.struct(F.col("o_orderkey"), order_record_json(orders).alias("j")).alias("r"),
    )
    pages = recs.groupBy("indicator_id", "run", "page_no").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    ind, faulty = F.col("indicator_id"), F.col("run") % FAULTY_RUNS == 0
    pages_field = (
        F.when((ind == NO_PAGES_INDICATOR) & faulty, F.lit(None))
        .when((ind == TEXT_PAGES[0]) & faulty, F.lit(f'"{TEXT_PAGES[1]}"'))
        .otherwise(F.lit("1000000"))
    )
    meta = _obj(
        ("page", F.col("page_no").cast("string")),
        ("pages", pages_field),
        ("per_page", F.lit(f'"{PAGE_SIZE}"')),
    )
    records = F.concat(F.lit("["), F.array_join(F.transform("rs", lambda r: r["j"]), ","), F.lit("]"))
    body = F.when(
        (ind == BAD_ENVELOPE_PAGE[0]) & (F.col("page_no") == BAD_ENVELOPE_PAGE[1]) & faulty, F.lit('{"message":"rate limited"}')
    ).otherwise(F.concat(F.lit("["), meta, F.lit(","), records, F.lit("]")))
    return pages.select(
        "indicator_id",
        "page_no",
        body.alias("body"),
        F.concat(F.lit("run_"), F.lpad(F.col("run").cast("string"), 6, "0")).alias("extract_run_id"),
        F.lit(RUN_TS).cast("timestamp_ntz").alias("ingested_at"),
    )


def event_bodies(events: DataFrame) -> DataFrame:
    """Captured indicator responses of one run a day, of one page each: as ``indicator_bodies``.

    run <- day of ts, requested id <- event_type and user_id div USERS_PER_LOCATION, country <- user, year <- 2000 + hour. The
    value follows from user, hour and day, so records of one key in one run are equal. event_id %43: no iso3 (a dead
    letter); %23: date "yyyyQ1" (a reject); requests of a group divisible by 7 on days divisible by 5: ``pages`` is no integer.
    """
    user, hour, day = F.col("user_id"), F.hour("ts"), F.dayofmonth("ts")
    iso3 = F.when(_mod(43), F.lit(None)).otherwise(_q(F.concat(F.lit("U"), F.lpad(user.cast("string"), 5, "0"))))
    record = _obj(
        ("countryiso3code", iso3),
        ("country", _obj(("value", _q(F.concat(F.lit("User "), user.cast("string")))))),
        ("indicator", _obj(("id", _q(F.col("event_type"))), ("value", _q(F.concat(F.lit("Indicator "), F.col("event_type")))))),
        ("date", _q(F.concat((hour + 2000).cast("string"), F.when(_mod(23), "Q1").otherwise("")))),
        ("value", (user * 7 + hour * 3 + day).cast("string")),
    )
    group = F.floor(user / USERS_PER_LOCATION)
    recs = events.select("event_type", group.alias("grp"), F.to_date("ts").alias("day"), F.struct("event_id", record.alias("j")).alias("r"))
    pages = recs.groupBy("event_type", "grp", "day").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    bad = (F.col("grp") % 7 == 0) & (F.dayofmonth("day") % 5 == 0)
    meta = F.when(bad, F.lit('{"page":1,"pages":"many"}')).otherwise(F.lit('{"page":1,"pages":1}'))
    body = F.concat(F.lit("["), meta, F.lit(",["), F.array_join(F.transform("rs", lambda r: r["j"]), ","), F.lit("]]"))
    return pages.select(
        F.concat("event_type", F.lit("_"), F.col("grp").cast("string")).alias("indicator_id"),
        F.lit(1).alias("page_no"),
        body.alias("body"),
        F.concat(F.lit("run_"), F.date_format("day", "yyyyMMdd")).alias("extract_run_id"),
        F.date_add("day", 1).cast("timestamp_ntz").alias("ingested_at"),
    )


# ---------------------------------------------------------------- hourly bodies (events)


def location_number() -> Column:
    return F.floor(F.col("user_id") / USERS_PER_LOCATION)


def location_of_user() -> Column:
    return F.concat(F.lit("L"), F.lpad(location_number().cast("string"), 6, "0"))


def location_spec() -> Column:
    """Configuration text ``id:lat:lon`` of a user's location (a rule, not a table)."""
    i = location_number() % 64
    return F.concat_ws(":", location_of_user(), (F.lit(40.0) + i * 0.5).cast("string"), (F.lit(-10.0) + i * 1.25).cast("string"))


def hourly_bodies(events: DataFrame) -> DataFrame:
    """Captured hourly payloads: ``location_id, source_variant, body, extract_run_id, ingested_at``.

    body = (location, variant = even/odd event_id -> archive/forecast, day, event_id div HOURLY_BUCKET);
    elements are ordered by ts. time <- local hour of ts (``yyyy-MM-ddTHH:00``), temperature <- value,
    precipitation <- props.k, wind <- user_id % 40 + 0.5. Element faults by event_id:
    %31 time null | %41 time "yyyy-MM-dd HH:mm" (bad) | %37 temperature "x" | %43 wind null.
    Body faults by (bucket + location number): %11 no wind array | %13 precipitation one short |
    %17 no ``hourly`` object. ingested_at = next day 00:00, run id = day || bucket.
    """
    loc_no = location_number()
    bucket = F.floor(F.col("event_id") / HOURLY_BUCKET)
    time_json = (
        F.when(_mod(31), F.lit("null"))
        .when(_mod(41), _q(F.date_format("ts", "yyyy-MM-dd HH:mm")))
        .otherwise(_q(F.date_format("ts", "yyyy-MM-dd'T'HH:00")))
    )
    temp_json = F.when(_mod(37), F.lit('"x"')).otherwise(F.col("value").cast("string"))
    precip_json = F.get_json_object("props", "$.k")
    wind_json = F.when(_mod(43), F.lit("null")).otherwise(((F.col("user_id") % 40).cast("double") + 0.5).cast("string"))
    elems = events.select(
        location_of_user().alias("location_id"),
        F.when(F.col("event_id") % 2 == 0, F.lit("archive")).otherwise(F.lit("forecast")).alias("source_variant"),
        F.to_date("ts").alias("day"),
        bucket.alias("bucket"),
        loc_no.alias("loc_no"),
        F.struct(
            F.col("ts"),
            time_json.alias("t"),
            temp_json.alias("a"),
            precip_json.alias("p"),
            wind_json.alias("w"),
        ).alias("e"),
    )
    bodies = elems.groupBy("location_id", "source_variant", "day", "bucket", "loc_no").agg(
        F.array_sort(F.collect_list("e")).alias("es")
    )

    def arr(field: str, drop_last: Column | None = None) -> Column:
        xs = F.transform("es", lambda e: e[field])
        if drop_last is not None:
            xs = F.when(drop_last, F.slice(xs, 1, F.size(xs) - 1)).otherwise(xs)
        return F.concat(F.lit("["), F.array_join(xs, ",", "null"), F.lit("]"))

    fault = (F.col("bucket") + F.col("loc_no"))
    hourly = _obj(
        ("time", arr("t")),
        ("temperature_2m", arr("a")),
        ("precipitation", arr("p", fault % 13 == 0)),
        ("wind_speed_10m", F.when(fault % 11 == 0, F.lit(None)).otherwise(arr("w"))),
    )
    body = F.when(fault % 17 == 0, F.lit('{"error":true,"reason":"no data"}')).otherwise(
        _obj(("timezone", _q(F.lit(HOURLY_TZ))), ("hourly", hourly))
    )
    return bodies.select(
        "location_id",
        "source_variant",
        body.alias("body"),
        F.concat(F.date_format("day", "yyyyMMdd"), F.lit("_"), F.lpad(F.col("bucket").cast("string"), 4, "0")).alias(
            "extract_run_id"
        ),
        F.date_add("day", 1).cast("timestamp_ntz").alias("ingested_at"),
    )


def hourly_payloads(events: DataFrame) -> DataFrame:
    return parse_once(hourly_bodies(events), "body", strict=True)
