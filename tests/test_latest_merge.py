from datetime import datetime

import pytest
from pyspark.sql import functions as F

from base_helpers import rows
from rawmart import schemas as S
from rawmart.functions import parse_once
from rawmart.operators.latest import latest_per_key
from rawmart.operators.merge import merge_plan, merge_upsert
from rawmart.plans import zones
from rawmart.session import session_conf

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
REC = '{{"countryiso3code":"GBR","country":{{"value":"UK"}},"indicator":{{"id":"I"}},"date":"2020","value":{v}}}'


def _raw(spark, items):
    df = spark.createDataFrame(items, "j string, ingested_at timestamp_ntz, extract_run_id string")
    return parse_once(df, "j", strict=True).withColumn("indicator_id", F.lit("I")).withColumn("source_file", F.lit(""))


def test_later_ingestion_wins(spark):
    # fx07
    stg = zones.stg_indicator_source(_raw(spark, [(REC.format(v=1), T1, "a"), (REC.format(v=2), T2, "a")]))
    assert rows(stg, "value_num") == [(2.0,)]


def test_larger_run_id_wins_on_equal_time(spark):
    # fx08
    stg = zones.stg_indicator_source(_raw(spark, [(REC.format(v=1), T1, "b"), (REC.format(v=2), T1, "a")]))
    assert rows(stg, "value_num", "extract_run_id") == [(1.0, "b")]


def test_non_integer_year_rejected_not_staged(spark):
    # fx03 / X5
    raw = _raw(spark, [(REC.format(v=1).replace('"2020"', '"2020Q1"'), T1, "a")])
    assert zones.stg_indicator_source(raw).count() == 0
    assert rows(zones.stg_indicator_rejects(raw), "reason", "date_text") == [("non_integer_year", "2020Q1")]


def test_value_and_name_nulls(spark):
    # fx04, fx05, fx06
    doc = '{"countryiso3code":"GBR","country":{"value":{"o":1}},"indicator":{"id":"OTHER"},"date":"2020","value":"n/a"}'
    stg = zones.stg_indicator_source(_raw(spark, [(doc, T1, "a")]))
    r = stg.first()
    assert (r.country_name, r.value_num, r.indicator_id) == (None, None, "OTHER")


def _hourly_raw(spark, items, tz_doc=None):
    df = spark.createDataFrame(items, "j string, source_variant string, ingested_at timestamp_ntz, extract_run_id string")
    return (
        parse_once(df, "j", strict=True)
        .withColumn("location_id", F.lit("london"))
        .withColumn("latitude", F.lit(51.5))
        .withColumn("longitude", F.lit(-0.1))
    )


def _h(times, temps, pre=None, wind=None):
    import json

    n = len(times)
    return json.dumps({"hourly": {"time": times, "temperature_2m": temps,
                                  "precipitation": pre if pre is not None else [0] * n,
                                  "wind_speed_10m": wind if wind is not None else [1] * n}})


def test_archive_beats_forecast_in_any_order(spark):
    # fx09 / X1
    a = (_h(["2025-01-01T00:00"], [1]), "archive", T1, "r")
    f = (_h(["2025-01-01T00:00"], [2]), "forecast", T1, "r")
    for items in ([a, f], [f, a]):
        stg = zones.stg_hourly_source(_hourly_raw(spark, items), "UTC")
        assert rows(stg, "temperature_2m") == [(1.0,)]


def test_alignment_tolerance(spark):
    # fx10 (forced into raw), fx11, fx13, fx14
    doc = _h(["2025-01-01T00:00", None, "2025-01-01T02:00"], [1, "x", None], pre=[5, 6], wind=None)
    import json

    d = json.loads(doc)
    del d["hourly"]["wind_speed_10m"]
    raw = _hourly_raw(spark, [(json.dumps(d), "archive", T1, "r")])
    got = rows(zones.hourly_rows(raw, "UTC"), "pos", "temperature_2m", "precipitation", "wind_speed_10m")
    assert got == [(0, 1.0, 5.0, None), (2, None, None, None)]


def test_bad_time_goes_to_rejects(spark):
    # fx15
    raw = _hourly_raw(spark, [(_h(["2025-01-01T00:00", "bad", "2025-01-01T01:00:00"], [1, 2, 3]), "archive", T1, "r")])
    assert zones.stg_hourly_source(raw, "UTC").count() == 1
    assert rows(zones.stg_hourly_rejects(raw, "UTC"), "reason", "time_text") == [("bad_time", "2025-01-01T01:00:00"), ("bad_time", "bad")]


def test_two_local_times_one_instant(spark):
    # fx17: London autumn overlap -> both 01:30 map to 00:30 UTC only for the first; 00:30 BST is 23:30 UTC
    raw = _hourly_raw(spark, [(_h(["2025-10-26T00:30", "2025-10-26T01:30"], [1, 2]), "archive", T1, "r"),
                              (_h(["2025-10-26T01:30"], [3]), "archive", T1, "r")])
    stg = zones.stg_hourly_source(raw, "Europe/London")
    assert stg.select("timestamp").distinct().count() == stg.count() == 2


def _stg(spark, items):
    return spark.createDataFrame(items, S.STG_INDICATOR)


def test_merge_plan_fixtures(spark):
    t = _stg(spark, [("GBR", "UK", "I", "x", 2020, 1.0, T1, "a"), ("FRA", "FR", "I", "x", 2020, 2.0, T1, "a")])
    s = _stg(spark, [("GBR", "UK", "I", "x", 2020, None, T2, "b"), ("USA", "US", "I", "x", 2020, 3.0, T2, "b")])
    out = merge_plan(t, s, S.INDICATOR_KEYS)
    # fx19 keeps FRA, fx20 NULL overwrites, inserts USA
    assert rows(out, "country_iso3", "value_num") == [("FRA", 2.0), ("GBR", None), ("USA", 3.0)]
    # fx21 / M3: twice == once
    assert rows(merge_plan(out, s, S.INDICATOR_KEYS)) == rows(out)


def test_recency_guard(spark):
    # fx22: an older source never overwrites
    t = _stg(spark, [("GBR", "UK", "I", "x", 2020, 1.0, T2, "b")])
    s = _stg(spark, [("GBR", "UK", "I", "x", 2020, 9.0, T1, "a")])
    assert rows(merge_plan(t, s, S.INDICATOR_KEYS, recency=["ingested_at", "extract_run_id"]), "value_num") == [(1.0,)]
    assert rows(merge_plan(t, s, S.INDICATOR_KEYS), "value_num") == [(9.0,)]


def test_null_keys_dropped_from_latest(spark):
    # fx23 / X4: NULL keys never reach staging
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    assert rows(latest_per_key(df, ["k"], ["v"], drop_null_keys=True)) == [("a", 2)]


def test_merge_upsert_rewrites_only_touched_partitions(spark, scratch):
    path = f"{scratch}/stg"
    first = zones.with_partition(_stg(spark, [("GBR", "UK", "I", "x", 2020, 1.0, T1, "a"), ("GBR", "UK", "I", "x", 1999, 5.0, T1, "a")]), "indicator")
    merge_upsert(spark, path, first, S.INDICATOR_KEYS, [S.INDICATOR_PART])
    second = zones.with_partition(_stg(spark, [("GBR", "UK", "I", "x", 2020, 2.0, T2, "b")]), "indicator")
    touched = merge_upsert(spark, path, second, S.INDICATOR_KEYS, [S.INDICATOR_PART])
    assert touched == [(121,)]
    got = rows(spark.read.parquet(path), "year", "value_num", S.INDICATOR_PART)
    assert got == [(1999, 5.0, 100), (2020, 2.0, 121)]
    # rerun is a no-op on the result
    merge_upsert(spark, path, second, S.INDICATOR_KEYS, [S.INDICATOR_PART])
    assert rows(spark.read.parquet(path), "year", "value_num", S.INDICATOR_PART) == got


def test_measure_longer_than_time_is_ignored(spark):
    # The driver array decides the rows; extra measure values are ignored
    raw = _hourly_raw(spark, [(_h(["2025-01-01T00:00"], [1, 2, 3], pre=[7, 8], wind=[9]), "archive", T1, "r")])
    got = rows(zones.hourly_rows(raw, "UTC"), "pos", "temperature_2m", "precipitation", "wind_speed_10m")
    assert got == [(0, 1.0, 7.0, 9.0)]


def test_year_long_payload(spark):
    # 8,760 hourly elements in one payload (a year of hours)
    from datetime import timedelta

    start = datetime(2024, 1, 1)
    times = [(start + timedelta(hours=i)).strftime("%Y-%m-%dT%H:%M") for i in range(8760)]
    raw = _hourly_raw(spark, [(_h(times, list(range(8760))), "archive", T1, "r")])
    stg = zones.stg_hourly_source(raw, "UTC")
    agg = stg.agg(F.count("*").alias("n"), F.sum("temperature_2m").alias("s")).first()
    assert (agg.n, agg.s) == (8760, float(sum(range(8760))))


def test_small_source_keys_are_broadcast_and_give_the_shuffled_result(spark):
    t = _stg(spark, [("GBR", "UK", "I", "x", 2020, 1.0, T2, "b"), ("FRA", "FR", "I", "x", 2020, 2.0, T1, "a"),
                     (None, "NA", "I", "x", 2020, 0.0, T1, "a")])
    s = _stg(spark, [("GBR", "UK", "I", "x", 2020, 9.0, T1, "a"), ("FRA", "FR", "I", "x", 2020, 3.0, T2, "c"),
                     ("USA", "US", "I", "x", 2020, 4.0, T2, "c"), (None, "NB", "I", "x", 2021, 5.0, T2, "c")])
    for recency in (None, ["ingested_at", "extract_run_id"]):
        plan = merge_plan(t, s, S.INDICATOR_KEYS, recency)
        a = rows(plan)
        assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()
        with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
            assert rows(merge_plan(t, s, S.INDICATOR_KEYS, recency)) == a, recency
    assert ("GBR", "UK", "I", "x", 2020, 1.0, T2, "b") in a  # the older source row is refused


def _upsert_tables(spark, scratch):
    path = f"{scratch}/stg"
    one = zones.with_partition(_stg(spark, [("GBR", "UK", "I", "x", 2020, 1.0, T1, "a"), ("FRA", "FR", "I", "x", 2020, 2.0, T1, "a")]), "indicator")
    two = zones.with_partition(_stg(spark, [("GBR", "UK", "I", "x", 2020, 7.0, T2, "b")]), "indicator")
    merge_upsert(spark, path, one, S.INDICATOR_KEYS, [S.INDICATOR_PART], recency=["ingested_at", "extract_run_id"])
    return path, two


def test_a_kill_inside_the_overwrite_is_repaired(spark, scratch, monkeypatch):
    import shutil

    from rawmart.operators import merge

    path, two = _upsert_tables(spark, scratch)

    def killed(spark, path, rows, part, cluster=()):
        shutil.rmtree(f"{path}/{S.INDICATOR_PART}=121")  # the old partition is gone, the new one not there yet
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(merge, "overwrite_partitions", killed)
        with pytest.raises(RuntimeError):
            merge_upsert(spark, path, two, S.INDICATOR_KEYS, [S.INDICATOR_PART], recency=["ingested_at", "extract_run_id"])
    assert merge.recover(spark, path, [S.INDICATOR_PART]) == 1
    want = [("FRA", 2.0), ("GBR", 7.0)]
    assert rows(spark.read.parquet(path), "country_iso3", "value_num") == want
    merge_upsert(spark, path, two, S.INDICATOR_KEYS, [S.INDICATOR_PART], recency=["ingested_at", "extract_run_id"])  # a replay
    assert rows(spark.read.parquet(path), "country_iso3", "value_num") == want


def test_a_kill_before_the_journal_is_complete_changes_nothing(spark, scratch):
    import os

    from rawmart.operators import merge

    path, two = _upsert_tables(spark, scratch)
    os.makedirs(f"{path}.journal/half")
    assert merge.recover(spark, path, [S.INDICATOR_PART]) == 0
    assert os.listdir(f"{path}.journal") == []
    merge_upsert(spark, path, two, S.INDICATOR_KEYS, [S.INDICATOR_PART], recency=["ingested_at", "extract_run_id"])
    assert rows(spark.read.parquet(path), "country_iso3", "value_num") == [("FRA", 2.0), ("GBR", 7.0)]


def test_upsert_leaves_no_scratch_also_after_a_failure(spark, scratch):
    import os

    from rawmart.session import scratch_path

    base = scratch_path(spark, "materialized/upsert_source").removeprefix("file:")
    before = set(os.listdir(base)) if os.path.exists(base) else set()
    path, two = _upsert_tables(spark, scratch)
    with pytest.raises(Exception, match="no_such"):
        merge_upsert(spark, path, two, ["no_such"], [S.INDICATOR_PART])
    assert set(os.listdir(base)) == before


def test_latest_value_by_indicator_has_one_defined_winner(spark):
    from rawmart.plans import consume

    mart = spark.createDataFrame([("B", "I", 2020, 1.0), ("A", "I", 2020, 2.0), ("C", "I", 2019, 3.0), ("A", "J", 2021, None)],
                                 "country_iso3 string, indicator_id string, year long, value_num double")
    assert rows(consume.latest_value(mart, by=("indicator_id",))) == [("I", "A", 2020, 2.0)]


def test_runs_of_the_same_time_and_late_runs_are_read(spark):
    from rawmart.operators.cursors import unseen_runs

    raw = spark.createDataFrame([("a", T2), ("b", T2), ("c", T1)], "extract_run_id string, ingested_at timestamp_ntz")
    assert rows(unseen_runs(raw, raw.where("extract_run_id = 'a'")), "extract_run_id") == [("b",), ("c",)]
