"""Plan checks: the shapes that matter at scale."""

import pytest

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def q():
    from rawmart.queries import QUERIES

    return QUERIES


def test_no_python_udfs(spark, q):
    for name in ["stg_indicator_latest", "stg_hourly_latest", "unwrap_pages", "merge_indicator", "kpi_latest"]:
        plan = _plan(q[name](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_latest_per_key_limits_before_shuffle(spark, q):
    df = q["stg_indicator_latest"](spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    ex = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning" in l)
    assert any("WindowGroupLimit" in l and "Partial" in l for l in lines[ex:]), plan


def test_scan_prunes_columns(spark, q):
    plan = _plan(q["stg_indicator_latest"](spark, SF))
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_partition_filter_on_mart_series(spark, tmp_path):
    from rawmart.plans import consume, zones
    from rawmart.queries import QUERIES

    mart = zones.with_partition(QUERIES["mart_hourly"](spark, SF), "hourly")
    path = str(tmp_path / "m")
    mart.write.partitionBy("event_date").parquet(path)
    df = consume.hourly_series(spark.read.parquet(path), ["L01"], "2024-01-05 00:00:00", "2024-01-06 00:00:00")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: [IsNotNull(location_id)" in plan


def test_zone_ddl(spark, tmp_path):
    from rawmart.plans.zones import create_zone_tables

    base = str(tmp_path / "wh")
    made = create_zone_tables(spark, base, "t_")
    assert len(made) == 6
    cols = [c.name for c in spark.catalog.listColumns("t_staging.stg_open_meteo_hourly")]
    assert cols[-2:] == ["_order", "event_date"] and "timestamp" in cols
    part = [c.name for c in spark.catalog.listColumns("t_mart.country_indicator_year") if c.isPartition]
    assert part == ["year_bucket"]
    # idempotent, but not for another place
    create_zone_tables(spark, base, "t_")
    with pytest.raises(ValueError, match="lies at"):
        create_zone_tables(spark, str(tmp_path / "other"), "t_")


def test_upsert_reads_only_touched_partitions(spark, tmp_path):
    from datetime import datetime

    from pyspark.sql import functions as F

    from rawmart import schemas as S
    from rawmart.operators.merge import partition_filter
    from rawmart.plans import zones

    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([("A", "n", "I", "x", y, 1.0, t, "r") for y in (1990, 2000, 2010)], S.STG_INDICATOR)
    path = str(tmp_path / "stg")
    zones.with_partition(df, "indicator").write.partitionBy("year_bucket").parquet(path)
    plan = _plan(spark.read.parquet(path).where(partition_filter(["year_bucket"], [(101,)])))
    assert "PartitionFilters: [isnotnull(year_bucket" in plan and "= 101)" in plan


def test_annual_series_filters_reach_the_scan(spark, tmp_path):
    from rawmart.plans import consume, zones
    from rawmart.queries import QUERIES

    mart = zones.with_partition(QUERIES["mart_indicator_year"](spark, SF), "indicator")
    path = str(tmp_path / "m")
    mart.write.partitionBy("year_bucket").parquet(path)
    df = consume.annual_series(spark.read.parquet(path), countries=["U00001"], indicators=["click"])
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(country_iso3), IsNotNull(indicator_id), In(country_iso3" in plan or (
        "In(country_iso3, [U00001])" in plan or "EqualTo(country_iso3,U00001)" in plan
    ), plan
    assert "ReadSchema: struct<country_iso3:string,indicator_id:string,year:bigint,value_num:double>" in plan


def test_bodies_are_not_broadcast_by_a_guessed_size(spark):
    # the broadcast side had a row for each body and was part of every task's memory
    from rawmart.queries import QUERIES

    df = QUERIES["array_null_time"](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
