from datetime import date, datetime

from pyspark.sql import functions as F

from base_helpers import rows
from rawmart.operators.cursors import last_time_cursor, max_year_cursor
from rawmart.functions import parse_once
from rawmart.sources.bodies import page_cut, page_errors, unwrap_pages, unwrap_with_errors
from rawmart.sources.config_text import id_list, parse_locations, request_window

T = datetime(2024, 1, 1)


def _bodies(spark, pages, ind="AG.LND"):
    return spark.createDataFrame([(ind, p, b, "r1", T) for p, b in pages],
                                 "indicator_id string, page_no int, body string, extract_run_id string, ingested_at timestamp_ntz")


P1 = '[{"page":1,"pages":2,"per_page":"4","total":5},[{"countryiso3code":"NOR","indicator":{"id":"AG.LND"},"date":"1998"},{"countryiso3code":"ECU","indicator":{"id":"AG.LND"},"date":"1997"},{"countryiso3code":"FJI","indicator":{"id":"AG.LND"},"date":"1990"},{"countryiso3code":"LAO","indicator":{"id":"AG.LND"},"date":"1989"}]]'
P2 = '[{"page":2,"pages":2,"per_page":"4","total":5},[{"countryiso3code":"MLT","indicator":{"id":"AG.LND"},"date":"1975"}]]'


def test_pages_are_chained_into_records(spark):
    recs = unwrap_pages(_bodies(spark, [(1, P1), (2, P2)]))
    assert recs.count() == 5
    assert max_year_cursor(recs).first().max_cursor_value == "1998"


def test_stop_before_empty_page(spark):
    # fx25
    p2 = '[{"page":2,"pages":3},[]]'
    p3 = P2.replace('"page":2,"pages":2', '"page":3,"pages":3')
    b = _bodies(spark, [(1, P1.replace('"pages":2', '"pages":3')), (2, p2), (3, p3)])
    assert rows(page_cut(b), "last_page") == [(1,)]
    assert unwrap_pages(b).count() == 4


def test_pages_missing_or_text(spark):
    # fx26
    no_pages = P1.replace('"pages":2,', "")
    assert rows(page_cut(_bodies(spark, [(1, no_pages), (2, P2)])), "last_page") == [(1,)]
    text_pages = P1.replace('"pages":2', '"pages":"2"')
    assert rows(page_cut(_bodies(spark, [(1, text_pages), (2, P2)])), "last_page") == [(2,)]


def test_gap_ends_pages(spark):
    p3 = P2.replace('"page":2,"pages":2', '"page":3,"pages":9')
    b = _bodies(spark, [(1, P1.replace('"pages":2', '"pages":9')), (3, p3)])
    assert rows(page_cut(b), "last_page") == [(1,)]


def test_bad_envelopes_and_non_objects(spark):
    # fx24, fx27
    for body in ['[{"message":"x"}]', "{}", "not json"]:
        assert unwrap_pages(_bodies(spark, [(1, body)])).count() == 0
    mixed = '[{"page":1,"pages":1},[1,"x",{"date":"2020"},null]]'
    assert unwrap_pages(_bodies(spark, [(1, mixed)])).count() == 1


def test_cursor_text_order(spark):
    # fx30
    b = '[{"page":1,"pages":1},[{"date":"999"},{"date":"2022"},{"date":""}]]'
    assert max_year_cursor(unwrap_pages(_bodies(spark, [(1, b)]))).first().max_cursor_value == "999"


def test_last_time_cursor(spark):
    df = spark.createDataFrame([('{"hourly":{"time":["2031-07-04T06:00","2031-07-04T07:00"]}}',),
                                ('{"hourly":{"time":["2030-02-11T23:00","2030-02-11T22:00"]}}',),
                                ('{"hourly":{"time":[]}}',), ('{"hourly":[]}',)], "j string")
    got = [r.c for r in parse_once(df, "j", strict=True).select(last_time_cursor("payload").alias("c")).collect()]
    assert got == ["2031-07-04T07:00", "2030-02-11T22:00", None, None]


def test_locations(spark):
    # fx29
    df = spark.createDataFrame([("oslo:59.9139:10.7522; ;quito:-0.1807:-78.4678;",)], "spec string")
    assert rows(parse_locations(df)) == [("oslo", 59.9139, 10.7522), ("quito", -0.1807, -78.4678)]


def test_bad_location_fails(spark):
    import pytest

    with pytest.raises(Exception):
        parse_locations(spark.createDataFrame([("oslo:59.9",)], "spec string")).collect()


def test_id_list_and_window(spark):
    df = spark.createDataFrame([(" AG.LND , ,EN.ATM ,", date(2025, 1, 10))], "s string, d date")
    r = df.select(id_list("s").alias("ids"), *[c.alias(n) for c, n in zip(request_window(F.col("d"), 7), ["a", "b"])]).first()
    assert r.ids == ["AG.LND", "EN.ATM"]
    assert (r.a, r.b) == (date(2025, 1, 4), date(2025, 1, 10))
    r0 = df.select(request_window(F.col("d"), 0)[0].alias("a")).first()
    assert r0.a == date(2025, 1, 10)


def test_bad_pages_value_is_visible_and_ends_nothing(spark):
    b = _bodies(spark, [(1, P1.replace('"pages":2', '"pages":"abc"')), (2, P2), (3, "<html>busy</html>")])
    recs, errors = unwrap_with_errors(b)
    assert recs.count() == 5
    assert rows(errors, "page_no", "reason", "body") == rows(page_errors(b), "page_no", "reason", "body")
    assert rows(errors, "page_no", "reason") == [(1, "bad_pages_value"), (3, "page_not_json")]
    assert rows(errors.where("page_no = 3"), "body") == [("<html>busy</html>",)]


def test_a_task_of_a_driver_table_holds_bounded_bytes(spark, tmp_path, monkeypatch):
    from rawmart.sources import driver_tables as D

    spark.range(5000).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    assert D.table(spark, str(tmp_path), "t").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(D, "TASK_BYTES", 1000)
    df = D.table(spark, str(tmp_path), "t")
    assert df.rdd.getNumPartitions() >= 20 and sorted(r[0] for r in df.collect()) == list(range(5000))


def test_a_stream_has_a_file_for_every_core_in_each_batch(spark, tmp_path):
    import glob

    from rawmart.version_queries import _bodies_stream

    bodies = spark.range(1000).selectExpr("CAST(id AS STRING) AS body")
    _bodies_stream(spark, str(tmp_path), bodies, 3)
    assert len(glob.glob(f"{tmp_path}/bodies/*.parquet")) == 3 * spark.sparkContext.defaultParallelism


def test_one_row_group_is_spread_however_many_splits_it_has(spark, tmp_path, monkeypatch):
    # a file of one row group counts as many splits, and all its rows came to one task
    from rawmart.session import session_conf
    from rawmart.sources import driver_tables as D

    spark.range(20000).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1"}):
        table = D.table(spark, str(tmp_path), "t")
        parts = table.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in parts) < 10000


def test_shuffle_partitions_follow_a_table(spark, tmp_path, monkeypatch):
    # with a fixed number of them, a task's rows grew with the table
    from rawmart.session import session_conf
    from rawmart.sources import driver_tables as D

    spark.range(5000).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    with session_conf(spark, {"spark.sql.shuffle.partitions": "3"}):
        D.table(spark, str(tmp_path), "t")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        monkeypatch.setattr(D, "SHUFFLE_BYTES", 1000)
        D.table(spark, str(tmp_path), "t")
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 20
