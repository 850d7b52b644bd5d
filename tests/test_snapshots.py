import os
import threading

import pytest
from base_helpers import rows
from pyspark.sql import functions as F

from rawmart.operators import snapshots
from rawmart.operators.snapshots import Conflict, Store, transact
from rawmart.session import create_once, path_exists

T = "staging/t"


def frame(spark, data):
    return spark.createDataFrame(data, "k string, p int, v long, at int")


def put(store, data, recency=("at",)):
    return transact(store, lambda txn: txn.upsert(T, frame(store.spark, data), ["k", "p"], "p", ["k"], recency, stats=["k"]))


def now(store, **how):
    return rows(store.read(T, **how), "k", "p", "v", "at")


def test_upsert_versions_and_old_readers(spark, scratch):
    store = Store(spark, scratch)
    assert store.state().version == 0
    assert put(store, [("a", 1, 10, 1), ("b", 1, 20, 1), ("c", 2, 30, 1)]) == {"p=1", "p=2"}
    opened = store.read(T)
    assert put(store, [("a", 1, 11, 2), ("d", 1, 40, 2)]) == {"p=1"}
    assert rows(opened, "k", "v") == [("a", 10), ("b", 20), ("c", 30)]  # a reader keeps the version it opened
    assert now(store) == [("a", 1, 11, 2), ("b", 1, 20, 1), ("c", 2, 30, 1), ("d", 1, 40, 2)]
    assert now(store, version=1) == [("a", 1, 10, 1), ("b", 1, 20, 1), ("c", 2, 30, 1)]
    put(store, [("a", 1, 99, 1), ("b", 1, 21, 1)])  # an older row is refused, an equally old one replaces
    assert now(store)[:2] == [("a", 1, 11, 2), ("b", 1, 21, 1)]
    put(store, [("a", 1, None, 0)], recency=None)
    assert now(store)[0] == ("a", 1, None, 0)
    assert store.versions() == [1, 2, 3, 4]


def test_an_empty_source_and_null_keys(spark, scratch):
    store = Store(spark, scratch)
    assert put(store, []) == set() and store.versions() == []
    put(store, [(None, 1, 1, 1), ("a", None, 2, 1)])
    put(store, [(None, 1, 3, 2), ("a", None, 4, 2)])
    assert now(store) == [("a", None, 2, 1), ("a", None, 4, 2), (None, 1, 1, 1), (None, 1, 3, 2)]  # null never matches null


STEPS = ("source", "data", "draft", "link")


@pytest.mark.parametrize("step", STEPS)
def test_a_kill_at_any_step_shows_the_old_version(spark, scratch, monkeypatch, step):
    store = Store(spark, scratch)
    put(store, [("a", 1, 10, 1)])

    def die(*a, **k):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        if step == "source":
            m.setattr(snapshots, "merge_newest", die)
        elif step == "data":
            m.setattr(snapshots.Transaction, "_entries", die)
        elif step == "draft":
            m.setattr(snapshots, "create_once", die)
        else:  # the draft of the commit file is written, the file itself is not
            m.setattr(snapshots, "create_once", lambda spark, path, text: open(f"{path}.x.tmp", "w").write(text) and die())
        with pytest.raises(RuntimeError):
            put(store, [("a", 1, 11, 2)])
    assert now(store) == [("a", 1, 10, 1)] and store.versions() == [1]
    put(store, [("a", 1, 12, 3)])
    assert now(store) == [("a", 1, 12, 3)]
    assert store.vacuum(keep=1, older_than_ms=0) >= 1  # the killed transaction's folders and version 1's go
    assert now(store) == [("a", 1, 12, 3)]


def test_interleaved_transactions_end_in_a_serial_order(spark, scratch):
    store = Store(spark, scratch)
    put(store, [("n", 1, 0, 0), ("m", 2, 0, 0)])
    one, two = store.begin(), store.begin()

    def add(txn, key, part):
        value = txn.read(T, {f"p={part}"}).where(F.col("k") == key).first()["v"]
        txn.upsert(T, frame(spark, [(key, part, value + 1, 0)]), ["k", "p"], "p", recency=["at"])

    add(one, "n", 1)
    add(two, "n", 1)
    assert two.commit() == 2
    with pytest.raises(Conflict):
        one.commit()
    other, third = store.begin(), store.begin()  # other partitions don't conflict
    add(other, "n", 1)
    add(third, "m", 2)
    assert (other.commit(), third.commit()) == (3, 4)
    assert now(store) == [("m", 2, 1, 0), ("n", 1, 2, 0)]


def test_threads_that_count_up_lose_no_step(spark, scratch):
    store = Store(spark, scratch)
    put(store, [("n", 1, 0, 0)])
    tries = []

    def step(txn):
        tries.append(1)
        value = txn.read(T, {"p=1"}).first()["v"]
        txn.upsert(T, frame(spark, [("n", 1, value + 1, 0)]), ["k", "p"], "p", recency=["at"])

    threads = [threading.Thread(target=lambda: transact(store, step)) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert now(store) == [("n", 1, 4, 0)] and len(tries) >= 4


def test_appends_never_conflict_and_compaction_keeps_rows(spark, scratch):
    store = Store(spark, scratch)
    txns = [store.begin() for _ in range(12)]
    for i, t in enumerate(txns):
        t.append("raw/t", frame(spark, [(f"k{i}", i % 2, i, i)]), "p", stats=["at"])
    for t in txns:
        t.commit()
    before = rows(store.read("raw/t"))
    assert len(before) == 12 and len(store.state().tables["raw/t"].entries) == 12
    assert store.compact("raw/t") == 2
    t = store.state().tables["raw/t"]
    assert rows(store.read("raw/t")) == before and len(t.entries) == 2 and sorted(e.rows for e in t.entries) == [6, 6]
    assert store.compact("raw/t") == 0
    store.vacuum(keep=1, older_than_ms=0)
    assert rows(store.read("raw/t")) == before
    assert sum(len(files) for _, _, files in os.walk(store.data("raw/t"))) <= 12


def test_compaction_and_an_append_of_the_same_partition(spark, scratch):
    store = Store(spark, scratch)
    for i in range(2):
        transact(store, lambda txn: txn.append("raw/t", frame(spark, [(f"k{i}", 1, i, i)]), "p"))  # noqa: B023
    late = store.begin()
    t = late.state.tables["raw/t"]
    late.replace("raw/t", store.read("raw/t", state=late.state), t.part, reads={"p=1"})
    transact(store, lambda txn: txn.append("raw/t", frame(spark, [("new", 1, 5, 5)]), "p"))
    with pytest.raises(Conflict):
        late.commit()
    assert store.read("raw/t").count() == 3


def test_added_fields_are_null_in_old_rows(spark, scratch):
    store = Store(spark, scratch)
    put(store, [("a", 1, 10, 1), ("c", 2, 30, 1)])
    wide = frame(spark, [("a", 1, 11, 2)]).withColumn("note", F.lit("x"))
    transact(store, lambda txn: txn.upsert(T, wide, ["k", "p"], "p", recency=["at"]))
    put(store, [("b", 1, 20, 3)])  # a source of the old form
    assert rows(store.read(T), "k", "v", "note") == [("a", 11, "x"), ("b", 20, None), ("c", 30, None)]
    with pytest.raises(ValueError, match="field v"):
        transact(store, lambda txn: txn.append(T, frame(spark, [("z", 1, 1, 1)]).withColumn("v", F.lit("text")), "p"))


def test_statistics_prune_folders(spark, scratch):
    store = Store(spark, scratch)
    put(store, [(chr(97 + i), i, i, 0) for i in range(10)])
    few = store.read(T, between={"k": ("c", "d")})
    assert len(few.inputFiles()) == 2 and rows(few.where("k between 'c' and 'd'"), "k") == [("c",), ("d",)]


def test_a_replayed_batch_is_not_marked_again(spark, scratch):
    store = Store(spark, scratch)

    def batch(n):
        def work(txn):
            if txn.mark("s", n):
                txn.append("raw/t", frame(spark, [("k", 1, n, n)]), "p")

        transact(store, work)

    for n in (0, 1, 1, 0, 2):
        batch(n)
    assert rows(store.read("raw/t"), "v") == [(0,), (1,), (2,)] and store.state().streams == {"s": 2}


def test_a_file_is_made_once(spark, scratch):
    path = f"{scratch}/commits/1"
    assert create_once(spark, path, "a") and not create_once(spark, path, "b")
    assert open(path).read() == "a" and [n for n in os.listdir(f"{scratch}/commits") if not n.startswith(".")] == ["1"]
    assert path_exists(spark, path)


def test_freshness_reads_no_data(spark, scratch):
    store = Store(spark, scratch)
    data = spark.createDataFrame([("a", 1, "2031-01-01 05:00:00"), ("b", 2, "2031-01-02 03:00:00")], "k string, p int, s string")
    data = data.select("k", "p", F.col("s").cast("timestamp_ntz").alias("ingested_at"))
    transact(store, lambda txn: txn.append("raw/t", data, "p", stats=["ingested_at"]))
    import shutil

    shutil.rmtree(store.data("raw/t"))
    got = snapshots.freshness(store, {"t": "raw/t", "none": "raw/none"}, "2031-01-02 05:00:00", 3).collect()
    assert [(r["source"], r["age_hours"], r["is_stale"]) for r in got] == [("t", 2.0, False), ("none", None, True)]


# ---------------------------------------------------------------- buckets
def put_bucketed(store, data, buckets=4, recency=("at",)):
    src = frame(store.spark, data)
    return transact(store, lambda txn: txn.upsert(T, src, ["k", "v"], "p", ["k"], recency, stats=["k"], buckets=buckets))


@pytest.mark.parametrize("recency", [("at",), None])
def test_bucketed_upserts_equal_plain_ones(spark, scratch, recency):
    batches = [[(f"k{i % 23}", i % 3, i % 23, i) for i in range(b, b + 40) if i % 23 >= b % 7] for b in (0, 20, 7)]
    batches = [list({(k, v): (k, v % 3, v, at) for k, _, v, at in batch}.values()) for batch in batches] + [[(None, 1, 4, 1), ("it's a\\b", 2, 2, 5), ("x", None, 3, 1)]] * 2
    plain, other = Store(spark, f"{scratch}/plain"), Store(spark, f"{scratch}/bucketed")
    for batch in batches:
        transact(plain, lambda txn: txn.upsert(T, frame(spark, batch), ["k", "v"], "p", ["k"], recency))  # noqa: B023
        put_bucketed(other, batch, recency=recency)
        assert now(other) == now(plain)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_a_bucketed_upsert_shuffles_the_source_only(spark, scratch):
    store = Store(spark, scratch)
    put_bucketed(store, [(f"k{i}", i % 2, i, 1) for i in range(500)], buckets=6)
    txn = store.begin()
    source = frame(spark, [(f"k{i}", i % 2, i, 2) for i in range(0, 500, 3)]).repartition(6, "k", "v")
    with store.read_buckets(T, txn.state, {"p=0", "p=1"}) as target:
        merged = snapshots.merge_newest(target, source, ["k", "v"], ["at"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 6 out of 6" in plan and plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
        assert merged.count() == 500 and merged.where("at = 2").count() == 167
    names = [n for _, _, files in os.walk(f"{scratch}/data/{T}") for n in files if n.endswith(".parquet")]
    assert len(names) <= 2 * 6  # at most one file for each bucket and partition


def test_a_layout_is_kept(spark, scratch):
    store = Store(spark, scratch)
    put_bucketed(store, [("a", 1, 1, 1)])
    with pytest.raises(ValueError, match="layout"):
        put_bucketed(store, [("a", 1, 1, 2)], buckets=5)
    with pytest.raises(ValueError, match="bucketed"):
        transact(store, lambda txn: txn.append(T, frame(spark, [("b", 1, 2, 1)]), "p"))
    with pytest.raises(ValueError, match="partition"):
        transact(store, lambda txn: txn.upsert("staging/u", frame(spark, [("b", 1, 2, 1)]), ["k", "p"], "p", buckets=2))
    transact(store, lambda txn: txn.upsert(T, frame(spark, [("a", 1, 1, 3)]), ["k", "v"], "p", recency=["at"]))  # the layout need not be named again
    transact(store, lambda txn: txn.replace(T, frame(spark, [("z", 2, 9, 1)]), "p"))
    assert now(store) == [("a", 1, 1, 3), ("z", 2, 9, 1)] and store.state().tables[T].buckets == snapshots.Buckets(4, ["k", "v"])


def test_statistics_read_the_path_once_a_file(spark, scratch):
    frame(spark, [("a", 1, 10, 1), ("b", 1, 20, 3), ("c", 2, None, 2), (None, None, 5, None)]).repartition(3).write.partitionBy("p").parquet(f"{scratch}/t")
    found = snapshots.folder_stats(spark.read.schema("k string, v long, at int, p int").parquet(f"{scratch}/t"), ["k", "v"])
    assert rows(found) == [("p=1", 2, "a", "b", 10, 20), ("p=2", 1, "c", "c", None, None), ("p=__HIVE_DEFAULT_PARTITION__", 1, None, None, 5, 5)]
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    rowwise = plan[next(i for i, line in enumerate(plan) if "file_path" in line and "Aggregate" not in line) :]
    assert "split(" in "".join(plan) and not any("split(" in line or "regexp" in line for line in rowwise)
