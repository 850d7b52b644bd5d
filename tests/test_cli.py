import os

from pyspark.sql import functions as F

from base_helpers import rows

P1 = '[{"page":1,"pages":2},[{"countryiso3code":"NOR","country":{"value":"Norge"},"indicator":{"id":"AG.LND"},"date":"1998","value":17}]]'
P2 = '[{"page":2,"pages":2},[{"countryiso3code":"ECU","country":{"value":"Quito"},"indicator":{"id":"AG.LND"},"date":"1998","value":5}]]'
H = '{"hourly":{"time":["2031-07-04T06:00","2031-07-04T07:00"],"temperature_2m":[12.5,13.25],"precipitation":[0.75,0],"wind_speed_10m":[8,9]}}'


def _write(base, rel, text):
    path = os.path.join(base, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_cli_run_from_captured_files(spark, tmp_path):
    from rawmart.__main__ import main

    cap = str(tmp_path / "captured")
    _write(cap, "ind/indicator_id=AG.LND/page_no=1/response.json", P1)
    _write(cap, "ind/indicator_id=AG.LND/page_no=2/response.json", P2)
    _write(cap, "hour/location_id=oslo/source_variant=archive/response.json", H)
    _write(cap, "hour/location_id=oslo/source_variant=forecast/response.json", H.replace("12.5", "21.5"))
    zones = str(tmp_path / "zones")
    res = main(
        ["--zones", zones, "--indicator-bodies", f"{cap}/ind", "--hourly-bodies", f"{cap}/hour",
         "--bodies-format", "files", "--locations", "oslo:59.9139:10.7522", "--tz", "Europe/Oslo",
         "--run-id", "r1", "--ingested-at", "2031-07-02T00:00:00"],
        spark=spark,
    )
    assert res.steps == ["stage_indicator", "stage_hourly", "mart_indicator", "mart_hourly"]
    assert rows(spark.read.parquet(f"{zones}/mart/country_indicator_year"), "country_iso3", "value_num") == [("ECU", 5.0), ("NOR", 17.0)]
    # archive wins the tie with forecast inside one run
    assert rows(spark.read.parquet(f"{zones}/mart/weather_hourly"), "temperature_2m") == [(12.5,), (13.25,)]


def test_cli_forecast_only(spark, tmp_path):
    from rawmart.__main__ import main

    cap = str(tmp_path / "captured")
    _write(cap, "hour/location_id=oslo/source_variant=archive/response.json", H)
    _write(cap, "hour/location_id=oslo/source_variant=forecast/response.json", H.replace("12.5", "21.5"))
    zones = str(tmp_path / "zones")
    main(["--zones", zones, "--hourly-bodies", f"{cap}/hour", "--bodies-format", "files",
          "--locations", "oslo:59.9139:10.7522", "--disable-archive", "--run-id", "r1",
          "--ingested-at", "2031-07-02T00:00:00"], spark=spark)
    assert rows(spark.read.parquet(f"{zones}/mart/weather_hourly"), "temperature_2m") == [(13.25,), (21.5,)]


def test_body_table_reader_json_and_parquet(spark, tmp_path):
    from datetime import datetime

    from rawmart import schemas as S
    from rawmart.sources.captured import read_body_table

    df = spark.createDataFrame([("AG.LND", 1, P1, "r1", datetime(2025, 1, 1), "extra")],
                               "indicator_id string, page_no int, body string, extract_run_id string, ingested_at timestamp_ntz, other string")
    df.write.json(str(tmp_path / "j"))
    df.write.parquet(str(tmp_path / "p"))
    for fmt, sub in (("json", "j"), ("parquet", "p")):
        got = read_body_table(spark, str(tmp_path / sub), S.INDICATOR_BODY, fmt)
        assert got.columns == S.INDICATOR_BODY.fieldNames()
        assert rows(got, "indicator_id", "page_no", "body") == [("AG.LND", 1, P1)]


def test_hourly_stream_equals_batch(spark, tmp_path):
    from rawmart import schemas as S
    from rawmart.plans import zones
    from rawmart.queries import QUERIES, _hourly_batch
    from rawmart.sources import driver_tables as D
    from rawmart.sources.landing import land_jsonl
    from rawmart.streaming import stream_upsert

    sf = "/root/testdata/sf0.001"
    raw, _ = _hourly_batch(spark, sf)
    base = str(tmp_path)
    land_jsonl(raw.repartition(3), f"{base}/landing", by_run=False)
    stream_upsert(spark, f"{base}/landing", S.RAW_HOURLY, lambda b: zones.stg_hourly_source(b, D.HOURLY_TZ, keep_order=True),
                  f"{base}/stg", S.HOURLY_KEYS, [S.HOURLY_PART], lambda d: zones.with_partition(d, "hourly"),
                  f"{base}/_ckpt", max_files_per_trigger=1)
    got = rows(spark.read.parquet(f"{base}/stg").select(*S.STG_HOURLY.fieldNames()))
    assert got == rows(QUERIES["stg_hourly_latest"](spark, sf))


def test_cli_rejects_bad_settings():
    import pytest

    from rawmart.__main__ import parse_args, validate

    for argv in (["--zones", "z"],
                 ["--zones", "z", "--hourly-bodies", "h"],
                 ["--zones", "z", "--hourly-bodies", "h", "--locations", "a:1:2", "--tz", "Mars/Base"],
                 ["--zones", "z", "--hourly-bodies", "h", "--locations", "a:1:2", "--disable-archive", "--disable-forecast"]):
        with pytest.raises(ValueError):
            validate(parse_args(argv))
    validate(parse_args(["--zones", "z", "--indicator-bodies", "i"]))


def test_cli_versioned_run(spark, tmp_path):
    import pytest

    from rawmart.__main__ import main

    cap, zones = str(tmp_path / "captured"), str(tmp_path / "zones")
    _write(cap, "ind/indicator_id=AG.LND/page_no=1/response.json", P1)
    _write(cap, "ind/indicator_id=AG.LND/page_no=2/response.json", P2)
    args = ["--zones", zones, "--indicator-bodies", f"{cap}/ind", "--bodies-format", "files", "--versioned", "--ingested-at", "2031-07-02T00:00:00"]
    for run in ("r1", "r2"):
        store = main([*args, "--run-id", run], spark=spark)
    assert store.versions() == [1, 2]
    assert rows(store.read("mart/country_indicator_year"), "country_iso3", "value_num") == [("ECU", 5.0), ("NOR", 17.0)]
    with pytest.raises(ValueError, match="whole run"):
        main([*args, "--steps", "mart_hourly"], spark=spark)
