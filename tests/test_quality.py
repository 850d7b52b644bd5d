import json
from datetime import datetime

from pyspark.sql import functions as F

from base_helpers import rows
from rawmart.functions import parse_once
from rawmart.operators.quality import hourly_valid, indicator_valid
from rawmart.plans import zones
from rawmart.sources.landing import land_jsonl, read_landed
from rawmart import schemas as S

TS = datetime(2024, 1, 1)


def _records(spark, docs):
    df = spark.createDataFrame([(i, d, "SP.FERRY.TRIPS", TS, "r1") for i, d in enumerate(docs)],
                               "i int, j string, indicator_id string, ingested_at timestamp_ntz, extract_run_id string")
    return parse_once(df, "j", strict=True)


def _record(**changed):
    """A record that is valid, with some of its fields changed; a field set to ``...`` is left out."""
    fields = {"indicator": {"id": "SP.FERRY.TRIPS", "value": "Ferry trips"}, "country": {"value": "Tonga"}, "countryiso3code": "TON", "date": "1987", "value": 41.25}
    return json.dumps({k: v for k, v in {**fields, **changed}.items() if v is not ...})


INDICATOR_CASES = [
    ("as it is", {}, True),
    ("empty code", {"countryiso3code": ""}, False),
    ("no code", {"countryiso3code": ...}, False),
    ("country as text", {"country": "Tonga"}, False),
    ("year with a quarter: a matter of staging", {"date": "1987Q3"}, True),
    ("date zero", {"date": 0}, False),
    ("empty indicator id", {"indicator": {"id": "", "value": "Ferry trips"}}, False),
]


def test_indicator_validity_fixtures(spark):
    df = _records(spark, [_record(**changed) for _, changed, _ in INDICATOR_CASES]).withColumn("ok", indicator_valid("payload"))
    got = {INDICATOR_CASES[r.i][0]: r.ok for r in df.collect()}
    assert got == {name: ok for name, _, ok in INDICATOR_CASES}


def test_split_is_a_partition_of_input(spark):
    docs = [_record(), _record(countryiso3code=""), _record(value=None), "[1,2]"]
    recs = _records(spark, docs)
    raw, dead = zones.indicator_batch(recs)
    assert raw.count() + dead.count() == recs.count()
    d = dead.first()
    assert d.source_name == "world_bank" and d.reason == "invalid_indicator_record"
    assert d.context == {"indicator_id": "SP.FERRY.TRIPS"}


def _hourly(spark, docs, variant="archive"):
    df = spark.createDataFrame([(i, d, "oslo", variant, TS, "r1") for i, d in enumerate(docs)],
                               "i int, j string, location_id string, source_variant string, ingested_at timestamp_ntz, extract_run_id string")
    return parse_once(df, "j", strict=True)


def _hours(**changed):
    """A payload of three hours, with some of its arrays changed; an array set to ``...`` is left out."""
    arrays = {"time": [f"2019-11-30T{h}:00" for h in (21, 22, 23)], "temperature_2m": [-3.5, -4, -4.25], "precipitation": [0, 0.5, None], "wind_speed_10m": [7, 11.5, 9]}
    return json.dumps({"hourly": {k: v for k, v in {**arrays, **changed}.items() if v is not ...}})


HOURLY_CASES = [
    ("as it is", _hours(), True),
    ("a measure shorter than the times", _hours(precipitation=[0, 0.5]), False),
    ("a measure missing", _hours(wind_speed_10m=...), False),
    ("no times", _hours(time=[], temperature_2m=[], precipitation=[], wind_speed_10m=[]), False),
    ("times as text", _hours(time="2019-11-30T21:00"), False),
    ("no hourly part", '{"daily":{}}', False),
    ("two measures missing", _hours(temperature_2m=..., wind_speed_10m=...), False),
]


def test_hourly_validity_fixtures(spark):
    df = _hourly(spark, [doc for _, doc, _ in HOURLY_CASES]).withColumn("ok", hourly_valid("payload"))
    assert {HOURLY_CASES[r.i][0]: r.ok for r in df.collect()} == {name: ok for name, _, ok in HOURLY_CASES}


def test_hourly_dead_letter_reason_and_coordinates(spark):
    locs = spark.createDataFrame([("oslo", 59.9139, 10.7522)], "location_id string, latitude double, longitude double")
    payloads = _hourly(spark, [_hours(), '{"daily":{}}'], "forecast")
    raw, dead = zones.hourly_batch(payloads, locs)
    r = raw.first()
    assert (r.latitude, r.longitude, r.source_variant) == (59.9139, 10.7522, "forecast")
    d = dead.first()
    assert d.reason == "invalid_forecast_payload" and d.context == {"location_id": "oslo", "source_variant": "forecast"}
    # switches (F8): forecast disabled -> nothing
    raw2, dead2 = zones.hourly_batch(payloads, locs, enabled_variants=("archive",))
    assert raw2.count() == 0 and dead2.count() == 0


def test_drift_read(spark, scratch):
    # fx28: extra top-level field ignored, broken line kept in the corrupt column
    path = f"{scratch}/land/extract_run_id=r1"
    import os

    os.makedirs(path)
    with open(f"{path}/a.json", "w") as fh:
        fh.write('{"indicator_id":"X","extra":1,"payload":{"date":"2025","new":[1]}}\n{broken\n')
    df = read_landed(spark, f"{scratch}/land", S.RAW_INDICATOR)
    got = rows(df.select("indicator_id", "extract_run_id", F.col("_corrupt").isNotNull().alias("bad"), F.to_json("payload").alias("p")))
    assert got == [("X", "r1", False, '{"date":"2025","new":[1]}'), (None, "r1", True, None)]


def test_landing_writes_nulls(spark, scratch):
    df = spark.createDataFrame([("r1", None)], "extract_run_id string, source_file string")
    land_jsonl(df, f"{scratch}/l", source_file=None)
    import glob

    text = open(glob.glob(f"{scratch}/l/extract_run_id=r1/*.json")[0]).read()
    assert '"source_file":null' in text
