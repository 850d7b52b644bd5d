from pyspark.sql import functions as F

from base_helpers import rows
from rawmart import schemas as S
from rawmart.plans.job import Zones, run_job

LOC = [("oslo", 59.9139, 10.7522)]
P1 = '[{"page":1,"pages":1},[{"countryiso3code":"NOR","country":{"value":"Norge"},"indicator":{"id":"AG.LND"},"date":"1998","value":17}]]'
H = '{"hourly":{"time":["2031-07-04T06:00"],"temperature_2m":[12.5],"precipitation":[0.75],"wind_speed_10m":[8]}}'


def _ind(spark, body):
    return spark.createDataFrame([("AG.LND", 1, body)], "indicator_id string, page_no int, body string")


def _hour(spark, body):
    return spark.createDataFrame([("oslo", "archive", body)], "location_id string, source_variant string, body string")


def _locs(spark):
    return spark.createDataFrame(LOC, "location_id string, latitude double, longitude double")


def _exists(path):
    import os

    return os.path.exists(path)


def test_nothing_fetched(spark, scratch):
    z = Zones(scratch)
    empty_i = _ind(spark, P1).where(F.lit(False))
    empty_h = _hour(spark, H).where(F.lit(False))
    res = run_job(spark, z, empty_i, empty_h, _locs(spark), "run1", "2031-07-02T00:00:00")
    assert res.landed == [] and res.steps == []
    assert not _exists(z.dead_letters) and not _exists(z.landing)


def test_dead_letters_only(spark, scratch):
    z = Zones(scratch)
    res = run_job(spark, z, None, _hour(spark, '{"hourly":{"time":["2031-07-04T06:00"],"precipitation":[0.75]}}'),
                  _locs(spark), "run1", "2031-07-02T00:00:00")
    assert res.landed == [] and res.steps == []
    assert res.metrics == {("open_meteo_response", "oslo/archive", "dead_letter"): 1}
    assert _exists(z.dead_letters) and not _exists(z.landing)


def test_full_run_and_rerun_is_idempotent(spark, scratch):
    z = Zones(scratch)
    args = (_ind(spark, P1), _hour(spark, H), _locs(spark))
    res = run_job(spark, z, *args, "run1", "2031-07-02T00:00:00")
    assert res.landed == ["world_bank_indicator", "open_meteo_response"]
    assert res.metrics == {("world_bank_indicator", "AG.LND", "valid"): 1, ("open_meteo_response", "oslo/archive", "valid"): 1}
    assert res.steps == ["stage_indicator", "stage_hourly", "mart_indicator", "mart_hourly"]
    first = (rows(spark.read.parquet(z.mart_indicator)), rows(spark.read.parquet(z.mart_hourly)))
    # a second run with the same data (new run id, later time) gives the same marts
    run_job(spark, z, *args, "run2", "2031-07-03T00:00:00")
    assert (rows(spark.read.parquet(z.mart_indicator)), rows(spark.read.parquet(z.mart_hourly))) == first
    stg = spark.read.parquet(z.stg_indicator)
    assert rows(stg, "extract_run_id") == [("run2",)]
    # raw keeps history (append), and the landing file name is recorded
    raw = spark.read.parquet(z.raw_indicator)
    assert raw.count() == 2
    assert raw.where(F.col("source_file").startswith("world_bank_indicator_run1_")).count() == 1
    hourly = spark.read.parquet(z.mart_hourly).first()
    assert hourly.temperature_2m == 12.5


def test_incremental_older_run_does_not_overwrite(spark, scratch):
    z = Zones(scratch)
    new = P1.replace('"value":17', '"value":18')
    run_job(spark, z, _ind(spark, new), None, _locs(spark), "run2", "2031-07-03T00:00:00")
    run_job(spark, z, _ind(spark, P1), None, _locs(spark), "run1", "2031-07-02T00:00:00")
    assert rows(spark.read.parquet(z.mart_indicator), "value_num") == [(18.0,)]


def test_raw_zone_payload_is_shredded(spark, scratch):
    import glob

    import pyarrow.parquet as pq

    z = Zones(scratch)
    run_job(spark, z, _ind(spark, P1), None, _locs(spark), "run1", "2031-07-02T00:00:00")
    f = glob.glob(f"{z.raw_indicator}/*/*.parquet")[0]
    paths = [c.path for c in pq.ParquetFile(f).schema]
    assert any(p.startswith("payload.typed_value.countryiso3code") for p in paths)
    # the setting was only for that write
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled", None) in (None, "false")


def test_a_failed_run_is_repaired_by_the_next(spark, scratch, monkeypatch):
    from rawmart.plans import job

    z = Zones(scratch)
    one, two = P1, P1.replace("NOR", "ECU")
    run_job(spark, z, _ind(spark, one), None, _locs(spark), "run1", "2031-07-01T00:00:00")
    for broken in ("merge_upsert", "overwrite_partitions"):  # in staging, then in the mart step
        body = two if broken == "merge_upsert" else P1.replace("NOR", "FJI")
        with monkeypatch.context() as m:
            def fail(*a, **k):
                raise RuntimeError("lost")

            m.setattr(job, broken, fail)
            try:
                run_job(spark, z, _ind(spark, body), None, _locs(spark), "run_" + broken, "2031-07-02T00:00:00")
                raise AssertionError("did not fail")
            except RuntimeError:
                pass
    assert len(job.unfinished(spark, z)) == 2
    run_job(spark, z, _ind(spark, P1.replace("NOR", "LAO")), None, _locs(spark), "run4", "2031-07-03T00:00:00")
    assert rows(spark.read.parquet(z.mart_indicator), "country_iso3") == [("ECU",), ("FJI",), ("LAO",), ("NOR",)]
    assert job.unfinished(spark, z) == []
    assert rows(spark.table(z.table("mart/country_indicator_year")), "country_iso3") == [("ECU",), ("FJI",), ("LAO",), ("NOR",)]


def test_the_newer_capture_wins_whatever_the_job_stamps(spark, scratch):
    from datetime import datetime

    z = Zones(scratch)
    bodies = spark.createDataFrame(
        [("AG.LND", 1, P1, "late", datetime(2031, 7, 9)), ("AG.LND", 1, P1.replace('"value":17', '"value":3'), "early", datetime(2031, 7, 8))],
        "indicator_id string, page_no int, body string, extract_run_id string, ingested_at timestamp_ntz",
    )
    res = run_job(spark, z, bodies, None, _locs(spark), "now", "2032-01-01T00:00:00")
    assert rows(spark.read.parquet(z.mart_indicator), "value_num") == [(17.0,)]
    assert res.cursors == {("world_bank_indicator", "AG.LND"): "1998"}


def test_bad_input_is_visible_or_fails_when_strict(spark, scratch):
    import json

    import pytest

    bad_hour = H.replace("2031-07-04T06:00", "2031-07-04 06:00")
    many = P1.replace('"pages":1', '"pages":"abc"')
    z = Zones(f"{scratch}/a")
    ind = spark.createDataFrame([("AG.LND", 1, many), ("AG.FST", 1, "<html>")], "indicator_id string, page_no int, body string")
    hour = spark.createDataFrame([("oslo", "archive", bad_hour), ("oslo", "forecast", "<html>"), ("rome", "archive", H)], "location_id string, source_variant string, body string")
    run_job(spark, z, ind, hour, _locs(spark), "r1", "2031-07-05T00:00:00")
    dead = spark.read.json(z.dead_letters).select("reason", F.col("payload").cast("string"))
    got = {r[0]: r[1] for r in dead.collect()}
    assert set(got) == {"bad_pages_value", "page_not_json", "invalid_forecast_payload", "unknown_location"}
    assert got["page_not_json"] == "<html>" and got["invalid_forecast_payload"] == "<html>"
    assert json.loads(got["bad_pages_value"])[0]["pages"] == "abc"
    assert rows(spark.read.json(z.rejects), "reason", "time_text") == [("bad_time", "2031-07-04 06:00")]
    with pytest.raises(ValueError, match="page_not_json|bad_pages_value"):
        run_job(spark, Zones(f"{scratch}/b"), ind, None, _locs(spark), "r1", "2031-07-05T00:00:00", strict=True)
    with pytest.raises(Exception, match="bad local time"):
        run_job(spark, Zones(f"{scratch}/c"), None, hour.where("body not like '<%'"), _locs(spark), "r1", "2031-07-05T00:00:00", strict=True)


def test_a_run_leaves_no_scratch(spark, scratch):
    import os

    from rawmart.session import scratch_path

    base = scratch_path(spark, "materialized").removeprefix("file:")
    have = lambda: {f"{d}/{x}" for d in (os.listdir(base) if os.path.exists(base) else []) for x in os.listdir(f"{base}/{d}")}
    before = have()
    run_job(spark, Zones(scratch), _ind(spark, P1), _hour(spark, H), _locs(spark), "r1", "2031-07-05T00:00:00")
    assert have() == before


def test_an_unknown_step_raises(spark, scratch):
    import pytest

    with pytest.raises(ValueError, match="no such step"):
        run_job(spark, Zones(scratch), _ind(spark, P1), None, _locs(spark), "r1", "2031-07-05T00:00:00", steps=["stage_all"])


def test_files_number_with_bytes_not_with_tasks(spark, scratch):
    import glob

    from rawmart.queries import _hourly_batch
    from rawmart.sources.landing import land_jsonl, write_dead_letters

    raw, dead = _hourly_batch(spark, "/root/testdata/sf0.01")
    daily = lambda df: df.withColumn("extract_run_id", F.date_format("ingested_at", "yyyyMMdd")).repartition(16)
    land_jsonl(daily(raw), f"{scratch}/landing")
    write_dead_letters(daily(dead), f"{scratch}/dead")
    for folder, depth in (("landing", "*"), ("dead", "*/*")):
        days = len(glob.glob(f"{scratch}/{folder}/{depth}"))
        assert len(glob.glob(f"{scratch}/{folder}/{depth}/*.json")) <= days + 4


def test_figures_of_a_run_stay_tables_until_they_are_looked_at(spark, scratch):
    from pyspark.sql import DataFrame

    bodies = spark.createDataFrame([(f"id{i}", 1, P1) for i in range(20)], "indicator_id string, page_no int, body string")
    res = run_job(spark, Zones(scratch), bodies, _hour(spark, H), _locs(spark), "run1", "2031-07-02T00:00:00", steps=[])
    assert all(isinstance(t, DataFrame) for t in res.metrics.tables + res.cursors.tables)
    assert len(res.metrics) == 21 and res.metrics[("world_bank_indicator", "id7", "valid")] == 1 and ("x", "y", "z") not in res.metrics
    assert res.cursors == {**{("world_bank_indicator", f"id{i}"): "1998" for i in range(20)}, ("open_meteo_response", "oslo/archive"): "2031-07-04T06:00"}
    assert list(res.report())[:2] == [("open_meteo_response", "oslo/archive", "valid", 1, "2031-07-04T06:00"), ("world_bank_indicator", "id0", "valid", 1, "1998")]


def test_sinks_with_many_run_folders_are_written_by_many_tasks(spark, scratch):
    import glob
    import hashlib

    from rawmart.sources.landing import land_jsonl

    rows_ = spark.range(0, 60000, 1, 8).select(F.concat(F.lit("r"), F.col("id") % 40).alias("extract_run_id"), F.sha2(F.col("id").cast("string"), 512).alias("a"))
    land_jsonl(rows_, f"{scratch}/l")
    tasks = {p.rsplit("part-", 1)[1][:5] for p in glob.glob(f"{scratch}/l/*/*.json")}
    assert len(tasks) > 1
    assert spark.read.schema("extract_run_id string, a string").json(f"{scratch}/l").where("extract_run_id = 'r7'").count() == 1500
    assert spark.read.schema("a string").json(f"{scratch}/l").where(F.col("a") == hashlib.sha512(b"31").hexdigest()).count() == 1


def test_a_run_parses_each_raw_row_once(spark, scratch, monkeypatch):
    from rawmart.plans import zones

    seen = []
    for name in ("indicator_typed", "hourly_rows"):
        own = getattr(zones, name)
        monkeypatch.setattr(zones, name, lambda *a, own=own, name=name, **k: (seen.append(name), own(*a, **k))[1])
    run_job(spark, Zones(scratch), _ind(spark, P1), _hour(spark, H), _locs(spark), "run1", "2031-07-02T00:00:00")
    assert sorted(seen) == ["hourly_rows", "indicator_typed"]


def test_files_number_with_folders_plus_bytes(spark, scratch):
    # F8: with more folders than shuffle partitions, every 2 MB of a part held a file of each of its folders
    import glob

    from rawmart.session import folder_count
    from rawmart.sources.landing import land_jsonl

    text = F.concat(*[F.sha2(F.concat("id", F.lit(f":{i}")).cast("string"), 512) for i in range(8)])
    rows_ = spark.range(0, 24000, 1, 8).select(F.concat(F.lit("r"), F.col("id") % 200).alias("extract_run_id"), text.alias("a"))
    land_jsonl(rows_, f"{scratch}/l", runs=folder_count(rows_, "extract_run_id"))
    assert len(glob.glob(f"{scratch}/l/*")) == 201 - (not glob.glob(f"{scratch}/l/_SUCCESS"))
    assert len(glob.glob(f"{scratch}/l/*/*.json")) <= 280
    assert spark.read.schema("extract_run_id string, a string").json(f"{scratch}/l").where("extract_run_id = 'r7'").count() == 120
