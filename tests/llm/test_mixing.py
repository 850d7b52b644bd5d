import re

import pytest
from llm_rows import prose
from pyspark.sql import functions as F

from rawmart.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def brute_targets(sizes, weights, share, most):
    """The excess of sources above their most is shared again until none is above."""
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, live, out = share * sum(sizes.values()), set(names), {}
    while True:
        total = sum(weight[n] for n in live)
        over = [n for n in live if left * weight[n] / total > most * sizes[n]] if live else []
        if not over:
            return out | {n: left * weight[n] / total for n in live}
        for n in over:
            out[n] = most * sizes[n]
        left -= sum(out[n] for n in over)
        live -= set(over)


def brute_seats(weights, seats):
    """Highest quotients, one seat at a time."""
    have = dict.fromkeys(weights, 0)
    for _ in range(seats):
        best = min(weights, key=lambda n: (-weights[n] / (2 * have[n] + 1), n))
        have[best] += 1
    return have


def by_source(out):
    rows = out.groupBy("source").agg(F.first("source_size").alias("size"), F.first("target").alias("target"), F.sum("taken").alias("taken"), F.sum("size").alias("words"))
    return {r["source"]: r for r in rows.collect()}


@pytest.mark.parametrize("weights, share, most", [((3, 1, 2), 1.5, 2), ((1,), 0.4, 1), ((5, 1), 2.5, 2), ((1, 2, 30), 2.9, 3)])
def test_targets_and_taken_words(spark, small, small_rows, weights, share, most):
    docs = small.withColumn("source", F.when(F.col("doc_id") % 17 == 3, F.lit(None)).when(F.col("doc_id") % 3 > 0, F.lit("é")).otherwise(F.col("source")))
    sizes = {}
    for r in docs.select("source", "text").collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
    want = brute_targets(sizes, weights, share, most)
    got = by_source(mixing.mix_sources(docs, weights, share, most))
    assert set(got) == set(want)
    for name, r in got.items():
        assert r["size"] == r["words"] == sizes[name]
        assert r["target"] == pytest.approx(min(want[name], most * sizes[name]), rel=1e-9)
        assert abs(r["taken"] - r["target"]) <= 3 * mixing.BLOCK


def test_one_source_with_most_rows_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "shard_count", lambda rows: 16)
    rows = [(i, prose(30 + i % 50, i), "big" if i % 3 else f"s{i % 4}") for i in range(900)] + [(900, prose(9000, 5), "long")]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix_sources(docs)
    for r in by_source(out).values():
        assert abs(r["taken"] - r["target"]) <= 0.02 * r["target"] + 2 * mixing.BLOCK
    assert out.where("taken > 2 * size or taken < 0").count() == 0


def test_apportionment_by_highest_quotients(spark):
    import random

    rng = random.Random(4)
    rows, want = [], {}
    for g in range(40):
        weights = {p: rng.choice([0, rng.randint(1, 9), rng.randint(1, 9), rng.randint(1, 2000)]) for p in range(rng.randint(1, 12))}
        seats = rng.choice([0, 1, rng.randint(0, 60), 500]) if any(weights.values()) else 0
        for p, n in brute_seats(weights, seats).items():
            want[g, p] = n
        rows += [(g, p, w, seats) for p, w in weights.items()]
    df = spark.createDataFrame(rows, "g int, p int, w long, seats long")
    got = {(r["g"], r["p"]): r["quota"] for r in mixing.apportion(df, ["g"], ["p"], "w", "seats").collect()}
    assert got == want


def test_what_is_taken_of_a_text(spark, small):
    out = mixing.mix_sources(small, with_text=True)
    changed = 0
    for r in out.collect():
        words = WORD.findall(r["text"] or "")
        want = words * r["passes"] + [w for b in r["blocks"] for w in words[b["first"] : b["stop"]]]
        assert r["mixed"] == " ".join(want) and r["taken"] == len(want) <= 2 * r["size"]
        changed += 0 < len(r["blocks"])
    assert changed


def test_reruns_agree_whatever_the_partitions(spark, small):
    plan = lambda docs, **how: sorted((r["doc_id"], r["taken"], str(r["blocks"])) for r in mixing.mix_sources(docs, **how).collect())
    one = plan(small)
    assert one == plan(small.repartition(7, "text")) == plan(small.orderBy(F.col("doc_id").desc()))
    assert one != plan(small, seed=1)


def test_edge_rows(spark, edge, empty):
    out = mixing.mix_sources(edge).collect()
    assert len(out) == 21
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[1]["size"] == by_id[2]["size"] == by_id[3]["size"] == 0 and by_id[1]["taken"] == 0
    assert by_id[10]["size"] == 3000 and by_id[None]["size"] == 200 and by_id[None]["source"] is None
    assert mixing.mix_sources(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], SCHEMA)
    assert sorted((r["doc_id"], r["target"], r["taken"]) for r in mixing.mix_sources(blank).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_repeated_rows_count_each(spark):
    rows = [(1, "a b c d " * 40, "x")] * 5 + [(2, "e " * 300, "y"), (None, "f " * 100, None)]
    out = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 7 and {r["source"]: r["source_size"] for r in out} == {"x": 800, "y": 300, None: 100}
