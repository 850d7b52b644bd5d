from datetime import datetime


from base_helpers import rows
from rawmart.functions import (
    is_array,
    is_object,
    json_scalar,
    local_ts_to_utc,
    parse_once,
    safe_double,
    safe_long,
    truthy,
    year_bucket,
)

DOC = '{"a":{"b":1},"c":[1,2],"d":null,"e":"","f":1.50,"g":"x","h":true,"i":0,"j":"0","k":{},"l":[],"m":false,"n":"{x"}'


def _doc(spark):
    return parse_once(spark.createDataFrame([(DOC,)], "j string"), "j", strict=True)


def test_json_scalar_rule(spark):
    d = _doc(spark)
    got = d.select(*[json_scalar("payload", f"$.{k}").alias(k) for k in "acdefghnz"]).first().asDict()
    # objects, arrays, JSON null and missing paths give NULL; numbers are normalised text
    assert got == {"a": None, "c": None, "d": None, "e": "", "f": "1.5", "g": "x", "h": "true", "n": "{x", "z": None}


def test_truthiness_like_python(spark):
    d = _doc(spark)
    expect = {"a": True, "c": True, "d": False, "e": False, "f": True, "g": True, "h": True,
              "i": False, "j": True, "k": False, "l": False, "m": False, "z": False}
    got = d.select(*[truthy("payload", f"$.{k}").alias(k) for k in expect]).first().asDict()
    assert got == expect


def test_object_array_tests(spark):
    d = _doc(spark)
    r = d.select(is_object("payload", "$.k").alias("o"), is_array("payload", "$.l").alias("a"),
                 is_object("payload", "$.g").alias("no"), is_array("payload", "$.zz").alias("na")).first()
    assert (r.o, r.a, r.no, r.na) == (True, True, False, False)


def test_safe_casts(spark):
    df = spark.createDataFrame([(s,) for s in ["2020", " 2020 ", "+5", "2020.5", "0x7E8", "", "1e3", "1.5d", "nan", "inf", "2020M01"]], "s string")
    got = {r.s: (r.l, r.d) for r in df.select("s", safe_long("s").alias("l"), safe_double("s").alias("d")).collect()}
    assert got["2020"] == (2020, 2020.0)
    assert got[" 2020 "] == (2020, 2020.0)
    assert got["+5"] == (5, 5.0)
    assert got["2020.5"] == (None, 2020.5)
    assert got["0x7E8"] == (2024, None)
    assert got[""] == (None, None)
    assert got["1e3"] == (None, 1000.0)
    assert got["inf"] == (None, float("inf")) and got["nan"][0] is None and got["nan"][1] != got["nan"][1]
    for s in ["1.5d", "2020M01"]:
        assert got[s] == (None, None), s


def test_local_time_to_utc_dst(spark):
    # fx16: gap hour moves forward, overlap takes the earlier instant; bad text -> NULL
    df = spark.createDataFrame([(s,) for s in ["2025-03-30T01:30", "2025-10-26T01:30", "2025-01-01T00:00:00", "bad", "2025-13-01T00:00"]], "s string")
    got = dict(df.select("s", local_ts_to_utc("s", "Europe/London").alias("u")).collect())
    assert got["2025-03-30T01:30"] == datetime(2025, 3, 30, 1, 30)
    assert got["2025-10-26T01:30"] == datetime(2025, 10, 26, 0, 30)
    assert got["2025-01-01T00:00:00"] is None and got["bad"] is None and got["2025-13-01T00:00"] is None


def test_local_time_session_zone_independent(spark):
    df = spark.createDataFrame([("2024-01-01T00:00",)], "s string")
    before = df.select(local_ts_to_utc("s", "America/New_York").alias("u")).first().u
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        after = df.select(local_ts_to_utc("s", "America/New_York").alias("u")).first().u
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert before == after == datetime(2024, 1, 1, 5, 0)


def test_strict_time_fails(spark):
    import pytest

    df = spark.createDataFrame([("2024-01-01 00:00",)], "s string")
    with pytest.raises(Exception):
        df.select(local_ts_to_utc("s", "UTC", strict=True).alias("u")).collect()


def test_year_bucket_edges(spark):
    # fx18
    df = spark.createDataFrame([(1899,), (1900,), (2199,), (2200,), (None,)], "y long")
    assert rows(df.select("y", year_bucket("y").alias("b"))) == [(1899, 0), (1900, 1), (2199, 300), (2200, 301), (None, None)]


def test_parse_once_blocks_repeated_parse(spark):
    df = parse_once(spark.createDataFrame([('{"a":1}',), ("not json",)], "j string"), "j")
    plan = df.where(json_scalar("payload", "$.a") == "1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    assert df.count() == 2  # text that is not JSON stays as a NULL payload


def test_casts_of_hex_and_special_numbers(spark):
    texts = ["0x1F", " -0xff ", "0x", "0x10000000000000000", "0xG1", "inf", "-Infinity", "+NaN", "infin", "1.5d", "0x1p3"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select(safe_long("t").alias("n"), safe_double("t").cast("string").alias("d")).collect()
    assert [r.n for r in got] == [31, -255, None, None, None, None, None, None, None, None, None]
    assert [r.d for r in got] == [None] * 5 + ["Infinity", "-Infinity", "NaN", None, None, None]
