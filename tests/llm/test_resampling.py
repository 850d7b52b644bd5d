import collections
import hashlib
import math
import zlib

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest
from llm_rows import SF

from rawmart.llm import resampling, text


def expected(docs, target, percent=10, min_words=20, most=1, buckets=10000):
    def features(value):
        words = brute.ALNUM_WORD.findall((value or "").translate(brute.LOW))
        return len(words), [brute.crc(" ".join(words[i : i + k])) % buckets for k in range(1, most + 1) for i in range(len(words) - k + 1)]

    s, t = collections.Counter(), collections.Counter()
    found = [(i, *features(x)) for i, x in docs]
    for _, _, f in found:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + float(buckets)) / ((s[b] + 1.0) * (all_t + float(buckets))))) for b in {*s, *t}}
    out = {}
    for i, n, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out[i] = (n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
    able = sorted((-v[3], i) for i, v in out.items() if v[0] >= min_words)
    rank = {i: k for k, (_, i) in enumerate(able[: percent * len(able) // 100], 1)}
    return {i: (v[1], v[2], v[3], rank.get(i)) for i, v in out.items()}


def got(df):
    return {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("percent, min_words, most, buckets", [(10, 20, 1, 10000), (50, 100, 2, 997), (100, 0, 3, 10000)])
def test_matches_brute_force(spark, small, small_rows, percent, min_words, most, buckets):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    out = got(resampling.resample(small, target, percent, min_words, most, buckets))
    assert out == expected(small_rows, [r["text"] for r in target.collect()], percent, min_words, most, buckets)
    assert any(r[3] for r in out.values())


def test_crcs_of_all_lengths():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in [1, 1, 2, 3, 3, 3, 8, 8, 64, 65, 66, 500, 500, 5000]]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    assert resampling.crc32s(data, ends - [len(p) for p in parts], ends).tolist() == [zlib.crc32(p) for p in parts]
    assert len(resampling.crc32s(data, ends[:0], ends[:0])) == 0


def test_features_of_a_chunk_stay_inside_their_rows():
    chunk = next(text.chunks(pa.array(["A b", None, "c", "b A b"]), 1 << 20))
    bucket, which, row, n = resampling.features(chunk, 2, 10000)
    want = [(0, "a"), (0, "b"), (2, "c"), (3, "b"), (3, "a"), (3, "b"), (0, "a b"), (3, "b a"), (3, "a b")]
    assert [(r, b) for r, b in zip(row.tolist(), bucket[which].tolist(), strict=True)] == [(r, zlib.crc32(f.encode()) % 10000) for r, f in want]
    assert n.tolist() == [2, 0, 1, 3]


def test_edge_rows(spark, edge, empty):
    target = spark.createDataFrame([("x y z",), (None,), ("",)], "text string")
    out = got(resampling.resample(edge, target, 50))
    rows = [(r[0], r[1]) for r in edge.toDF(*[f"c{i}" for i in range(len(edge.columns))]).collect()]
    want = expected([(1 << 62 if i is None else i, t) for i, t in rows], ["x y z"], 50)
    assert len(out) == 21 and {i: r[:2] for i, r in out.items()} == {None if i == 1 << 62 else i: r[:2] for i, r in want.items()}
    assert out[1][:2] == out[2][:2] == (0, 0) and out[1][3] is None
    assert sorted(r[3] for r in out.values() if r[3]) == list(range(1, 1 + sum(1 for r in out.values() if r[3])))
    assert got(resampling.resample(empty, target)) == {}
    nothing = spark.createDataFrame([], "text string")
    assert got(resampling.resample(edge, nothing, 50)).keys() == out.keys()


def test_ties_go_to_the_smaller_id_and_repeated_rows_are_ranked_each(spark):
    docs = spark.createDataFrame([(5, "a b c " * 10)] * 4 + [(7, "a b c " * 10)], "doc_id long, text string")
    target = spark.createDataFrame([("a a a",)], "text string")
    ranks = [(r["rank"], r["doc_id"]) for r in resampling.resample(docs, target, 100).collect()]
    assert sorted(r for r, _ in ranks) == [1, 2, 3, 4, 5]
    fives = sorted(r for r, i in ranks if i == 5)
    assert fives in ([1, 2, 3, 4], [2, 3, 4, 5])


def test_draw_prefers_documents_like_the_target(spark, small):
    like = small.where("doc_id % 10 = 0")
    drawn = resampling.resample(small, like, 20).where("rank is not null")
    weights = {r["doc_id"]: r["weight"] for r in resampling.resample(small, like, 20).collect()}
    mean = lambda ids: sum(weights[i] for i in ids) / len(ids)
    ids = [r["doc_id"] for r in drawn.collect()]
    assert mean(ids) > mean(list(weights))
    assert {r["doc_id"] for r in resampling.sample(small, drawn).collect()} == set(ids)
