import random

import pytest
from base_helpers import rows
from pyspark.sql import functions as F

from rawmart import fixed as X
from rawmart import schemas as S
from rawmart.operators import snapshots
from rawmart.operators.clustering import CELL, with_cells
from rawmart.operators.snapshots import Store, transact
from rawmart.plans import ingest
from rawmart.sources.bodies import page_cut

LOC = [("oslo", 59.9139, 10.7522)]
PAGE = '[{{"page":1,"pages":1}},[{{"countryiso3code":"NOR","country":{{"value":"Norge"}},"indicator":{{"id":"AG.LND"}},"date":"{year}","value":{v}}}]]'
HOUR = '{{"hourly":{{"time":["{t}"],"temperature_2m":[{v}],"precipitation":[0.75],"wind_speed_10m":[8]}}}}'
BROKEN = '{"hourly":{"time":["2031-07-04T06:00"],"precipitation":[0.75]}}'
MART_I, MART_H = f"mart/{X.MART_INDICATOR_TABLE}", f"mart/{X.MART_HOURLY_TABLE}"


def _ind(spark, year=1998, v=17):
    return spark.createDataFrame([("AG.LND", 1, PAGE.format(year=year, v=v))], "indicator_id string, page_no int, body string")


def _hour(spark, *bodies, place="oslo"):
    return spark.createDataFrame([(place, "archive", b) for b in bodies], "location_id string, source_variant string, body string")


def _run(spark, store, ind, hour, run, at, **how):
    locations = spark.createDataFrame(LOC, "location_id string, latitude double, longitude double")
    return ingest.run_once(spark, store, ind, hour, locations, run, at, **how)


def test_a_run_is_one_version_and_a_rerun_changes_no_mart(spark, scratch):
    store = Store(spark, scratch)
    hour = _hour(spark, HOUR.format(t="2031-07-04T06:00", v=12.5))
    assert _run(spark, store, _ind(spark), hour, "run1", "2031-07-05T00:00:00") == [X.RAW_INDICATOR_TABLE, X.RAW_HOURLY_TABLE]
    assert store.versions() == [1]
    first = (rows(store.read(MART_I)), rows(store.read(MART_H)))
    assert len(first[0]) == len(first[1]) == 1
    _run(spark, store, _ind(spark), hour, "run2", "2031-07-06T00:00:00")
    assert (rows(store.read(MART_I)), rows(store.read(MART_H))) == first
    assert rows(store.read(f"staging/{X.STG_INDICATOR_TABLE}"), "extract_run_id") == [("run2",)]
    assert store.read(ingest.raw_table(X.RAW_INDICATOR_TABLE)).count() == 2
    assert rows(store.read(ingest.METRICS), "source", "entity", "extract_run_id", "outcome", "records") == sorted(
        (s, e, r, "valid", 1) for s, e in (("open_meteo", "oslo/archive"), ("world_bank", "AG.LND")) for r in ("run1", "run2")
    )


def test_dead_letters_without_valid_rows(spark, scratch):
    store = Store(spark, scratch)
    assert _run(spark, store, None, _hour(spark, BROKEN), "run1", "2031-07-05T00:00:00") == []
    assert rows(store.read(ingest.DEAD), "reason", "extract_run_id") == [("invalid_archive_payload", "run1")]
    assert MART_H not in store.state().tables
    assert rows(store.read(ingest.METRICS), "outcome", "records") == [("dead_letter", 1)]


def test_rejects_and_older_runs(spark, scratch):
    store = Store(spark, scratch)
    _run(spark, store, None, _hour(spark, HOUR.format(t="2031-07-04T06:00", v=2), HOUR.format(t="2031-07-04 06:00", v=3)), "b", "2031-07-06T00:00:00")
    _run(spark, store, None, _hour(spark, HOUR.format(t="2031-07-04T06:00", v=1)), "a", "2031-07-05T00:00:00")
    assert rows(store.read(MART_H), "temperature_2m") == [(2.0,)]
    assert rows(store.read(ingest.reject_table(X.RAW_HOURLY_TABLE)), "reason", "time_text") == [("bad_time", "2031-07-04 06:00")]


@pytest.mark.parametrize("step", ["append", "upsert", "replace", "commit"])
def test_a_killed_run_shows_nothing_of_itself(spark, scratch, monkeypatch, step):
    store = Store(spark, scratch)
    _run(spark, store, _ind(spark), None, "run1", "2031-07-05T00:00:00")
    state = store.state().to_json()

    def die(*a, **k):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(snapshots.Transaction, step, die)
        with pytest.raises(RuntimeError, match="killed"):
            _run(spark, store, _ind(spark, v=18), None, "run2", "2031-07-06T00:00:00")
    assert store.state().to_json() == state
    _run(spark, store, _ind(spark, v=19), None, "run3", "2031-07-07T00:00:00")
    assert rows(store.read(MART_I), "value_num") == [(19.0,)] and store.read(ingest.raw_table(X.RAW_INDICATOR_TABLE)).count() == 2


def test_an_overlapping_run_is_taken_again(spark, scratch, monkeypatch):
    store = Store(spark, scratch)
    _run(spark, store, _ind(spark), None, "run0", "2031-07-05T00:00:00")
    commit, tries = snapshots.Transaction.commit, []

    def late(txn):
        tries.append(txn.id)
        if len(tries) == 1:  # another run of the same partitions ends first
            _run(spark, store, _ind(spark, v=50), None, "other", "2031-07-08T00:00:00")
        return commit(txn)

    with monkeypatch.context() as m:
        m.setattr(snapshots.Transaction, "commit", late)
        _run(spark, store, _ind(spark, v=40), None, "mine", "2031-07-07T00:00:00")
    assert len(tries) == 3
    assert rows(store.read(MART_I), "value_num") == [(50.0,)]  # the newer run's value
    assert rows(store.read(ingest.raw_table(X.RAW_INDICATOR_TABLE)), "extract_run_id") == [("mine",), ("other",), ("run0",)]


def test_cursors_name_the_next_requests(spark, scratch):
    store = Store(spark, scratch)
    places = spark.createDataFrame([*LOC, ("bergen", 60.0, 5.0)], "location_id string, latitude double, longitude double")
    ids = spark.createDataFrame([("AG.LND",), ("NEW",)], "indicator_id string")
    ask = lambda: (
        rows(ingest.indicator_requests(ingest.cursors(store), ids, 1960, 2031)),
        rows(ingest.hourly_requests(ingest.cursors(store), places, F.array(F.lit("a"), F.lit("b")), "UTC", F.lit("2031-07-10").cast("date"), 3), "location_id", "hourly", "start_date", "end_date"),
    )
    none = ("bergen", "a,b", "2031-07-08", "2031-07-10")
    assert ask() == ([("AG.LND", "1960:2031"), ("NEW", "1960:2031")], [none, ("oslo", *none[1:])])
    _run(spark, store, _ind(spark, 2005), _hour(spark, HOUR.format(t="2031-07-04T06:00", v=1)), "run1", "2031-07-05T00:00:00")
    _run(spark, store, _ind(spark, 1999), _hour(spark, HOUR.format(t="2031-07-02T06:00", v=1)), "run2", "2031-07-06T00:00:00")  # cursors never go back
    assert ask() == ([("AG.LND", "2005:2031"), ("NEW", "1960:2031")], [none, ("oslo", "a,b", "2031-07-04", "2031-07-10")])


def test_old_and_new_cursors_go_with_their_marts(spark, scratch):
    store = Store(spark, scratch)
    for year in (2001, 2002):
        _run(spark, store, _ind(spark, year), None, f"run{year}", f"{year}-12-31T00:00:00")
    assert rows(ingest.cursors(store, 1), "cursor") == [("2001",)] and store.read(MART_I, version=1).count() == 1
    assert rows(ingest.cursors(store), "cursor") == [("2002",)] and store.read(MART_I).count() == 2


def _pages(rng, runs):
    out = []
    for run in range(runs):
        n, stop = rng.randint(1, 7), rng.choice([None, 1, 2, 4, 20])
        numbers = [p for p in range(1, n + 1) if rng.random() > 0.1]
        for p in numbers:
            body = "[{}]".format(",".join(['{"page":1' + (f',"pages":{stop}' if stop else ',"pages":99') + "}", "[]" if rng.random() < 0.1 else '[{"a":1}]']))
            out.append((f"r{run}", "I", p, rng.choice([body] * 9 + ["nonsense"])))
    return out


@pytest.mark.parametrize("files, seed", [(1, 1), (4, 2), (9, 3)])
def test_page_rule_over_a_stream_equals_the_batch_rule(spark, scratch, files, seed):
    from rawmart.streaming import exact

    data = _pages(random.Random(seed), 25)
    random.Random(seed).shuffle(data)
    bodies = spark.createDataFrame([(*r, None) for r in data], "extract_run_id string, indicator_id string, page_no int, body string, ingested_at timestamp_ntz")
    for i in range(files):
        spark.createDataFrame(bodies.collect()[i::files], bodies.schema).coalesce(1).write.mode("append").parquet(f"{scratch}/pages")
    store = Store(spark, f"{scratch}/store")
    stream = spark.readStream.schema(bodies.schema).option("maxFilesPerTrigger", "1").parquet(f"{scratch}/pages")
    exact.stream_pages(spark, stream, f"{scratch}/ckpt", store, "pages")
    kept = store.read("capture/kept_page")
    want = page_cut(bodies).where("last_page > 0")
    assert rows(kept.groupBy("extract_run_id", "indicator_id").agg(F.max("page_no")), "extract_run_id", "max(page_no)") == rows(want, "extract_run_id", "last_page")
    assert kept.count() == kept.distinct().count() == sum(r["last_page"] for r in want.collect())


def test_cells_keep_all_rows_and_prune_both_keys(spark, scratch):
    store = Store(spark, scratch)
    data = spark.range(4000).select((F.col("id") * 7919 % 4000).alias("n"), F.concat(F.lit("k"), F.lpad((F.col("id") * 31 % 4000).cast("string"), 4, "0")).alias("s"))
    data = data.union(spark.createDataFrame([(None, None)], data.schema))
    transact(store, lambda txn: txn.append("mart/z", with_cells(data, ["n", "s"], bits=3), CELL, stats=["n", "s"]))
    assert rows(store.read("mart/z"), "n", "s") == rows(data)
    cells = len(store.state().tables["mart/z"].entries)
    part = store.read("mart/z", between={"n": (9, 450), "s": ("k1000", "k1400")})
    folders = {f.rsplit("/", 1)[0] for f in part.inputFiles()}
    assert cells >= 60 and len(folders) <= 8
    want = "n between 9 and 450 and s between 'k1000' and 'k1400'"
    assert rows(part.where(want), "n", "s") == rows(data.where(want)) != []
    assert len({f.rsplit("/", 1)[0] for f in store.read("mart/z", between={"n": (0, 400)}).inputFiles()}) <= 16


def test_raw_schema_survives_the_commit_file(spark, scratch):
    store = Store(spark, scratch)
    _run(spark, store, _ind(spark), None, "run1", "2031-07-05T00:00:00")
    raw = store.read(ingest.raw_table(X.RAW_INDICATOR_TABLE))
    assert [(f.name, f.dataType) for f in raw.schema.fields][:5] == [(f.name, f.dataType) for f in S.RAW_INDICATOR.fields]
