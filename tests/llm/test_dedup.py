import numpy as np
import llm_brute as brute
import pytest
from llm_rows import EDGE

from rawmart.llm import hyperminhash, substring_dedup, suffix_index
from rawmart.llm.components import components


def _by_id(df, *cols):
    out = {}
    for r in df.collect():
        assert r["doc_id"] not in out
        out[r["doc_id"]] = tuple(r[c] for c in cols)
    return out


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(small, small_rows, k, percent):
    got = _by_id(hyperminhash.near_duplicates(small, k, percent), "n_shingles", "component_id")
    assert got == brute.near_duplicates(small_rows, k, percent)


def test_near_duplicates_edge_rows(edge):
    got = _by_id(hyperminhash.near_duplicates(edge, 3, 85), "n_shingles", "component_id", "kept")
    want = brute.near_duplicates([(i, t) for i, t in EDGE], 3, 85)
    assert {i: v[:2] for i, v in got.items() if i is not None} == want
    assert got[None][1:] == (None, True)
    assert all(kept == (i == c) for i, (_, c, kept) in got.items() if i is not None)


def test_near_duplicates_family_without_a_common_base(spark):
    # a chain: neighbours are linked, the ends are not; plus many variants of one text
    words = [f"w{i}" for i in range(400)]
    chain = [(i, " ".join(words[i * 8 : i * 8 + 200])) for i in range(20)]
    family = [(100 + i, " ".join(w if j != i * 5 else "changed" + str(i) for j, w in enumerate(f"v{j}" for j in range(300)))) for i in range(50)]
    rows = chain + family
    got = _by_id(hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85), "n_shingles", "component_id")
    assert got == brute.near_duplicates(rows, 3, 85)


@pytest.mark.parametrize(("k", "percent", "sizes"), [(5, 80, [(4, 5), (8, 10), (5, 6)]), (3, 85, [(6, 7), (12, 14), (17, 20)])])
def test_near_duplicates_of_short_texts(spark, k, percent, sizes):
    # pairs at or just above the limit, each of its own words
    rows = []
    for pair in range(1800):
        n, m = sizes[pair % 3]
        words = [f"p{pair}w{i}" for i in range(m + k - 1)]
        rows += [(2 * pair, " ".join(words[: n + k - 1])), (2 * pair + 1, " ".join(words))]
    got = _by_id(hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k, percent), "component_id")
    assert [i for i, (c,) in got.items() if c != i - i % 2] == []
    assert {i: (c,) for i, c in ((i, v[1]) for i, v in brute.near_duplicates(rows[:300], k, percent).items())} == {i: got[i] for i in range(300)}


def test_near_duplicates_blocks_of_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(hyperminhash, "BUCKET_BLOCK", 4)
    monkeypatch.setattr(hyperminhash, "FAMILY_BLOCK", 3)
    base = [f"b{i}" for i in range(100)]
    # two families in the same buckets that don't link: half of the words are shared
    rows = [(i, " ".join(base[:60] + [f"f{i % 7}x{j}" for j in range(12)] + [f"z{i}"])) for i in range(40)]
    got = _by_id(hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85), "n_shingles", "component_id")
    assert got == brute.near_duplicates(rows, 3, 85)


def test_repeated_rows_are_kept_and_linked(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "quite other words here"), (2, "quite other words here"), (3, None), (3, None)]
    got = hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert sorted((r["doc_id"], r["component_id"]) for r in got.collect()) == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 3), (3, 3)]


def test_empty_tables(empty):
    assert hyperminhash.near_duplicates(empty).count() == 0
    assert substring_dedup.dedup_windows(empty).count() == 0
    assert suffix_index.dedup_bytes(empty).count() == 0


def test_estimate_is_corrected_for_collisions():
    rng = np.random.default_rng(5)
    n, errors = 40000, []
    for _ in range(30):
        a, b = (np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)) for _ in range(2))
        value, _ = hyperminhash.estimate(hyperminhash.registers(a)[None], hyperminhash.registers(b)[None], np.array([n]), np.array([n]))
        errors.append(value[0])
    assert np.mean(errors) < 0.002  # unrelated sets


def test_registers_of_close_sets_estimate_their_similarity():
    rng = np.random.default_rng(6)
    value = []
    for _ in range(20):
        h = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
        a, b = np.sort(h[:3600]), np.sort(h[400:])
        value.append(hyperminhash.estimate(hyperminhash.registers(a)[None], hyperminhash.registers(b)[None], np.array([3600]), np.array([3600]))[0][0])
    assert abs(np.mean(value) - 0.8) < 0.03


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, 1001 + i) for i in range(30)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(path + star, "x long, y long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 1000 for i in range(1000, 1031)}}


def test_cover_is_a_perfect_difference_set():
    c = substring_dedup.COVER
    assert sorted((a - b) % substring_dedup.PERIOD for a in c for b in c if a != b) == list(range(1, substring_dedup.PERIOD))


def test_window_dedup_matches_brute_force(small, small_rows):
    assert _by_id(substring_dedup.dedup_windows(small), "n_words", "n_removed", "kept_sha256") == brute.window_dedup(small_rows)


def test_window_dedup_edge_rows(edge):
    got = _by_id(substring_dedup.dedup_windows(edge, with_text=True), "n_words", "n_removed", "kept_sha256")
    want = brute.window_dedup([(i if i is not None else 1 << 63, t) for i, t in [*EDGE, (None, EDGE[5][1])]])
    assert got == {(None if i == 1 << 63 else i): v for i, v in want.items()}


def test_byte_dedup_matches_brute_force(small, small_rows):
    assert _by_id(suffix_index.dedup_bytes(small), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.byte_dedup(small_rows)


def test_byte_dedup_edge_rows(edge):
    got = _by_id(suffix_index.dedup_bytes(edge), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = brute.byte_dedup([(i if i is not None else 1 << 63, t) for i, t in [*EDGE, (None, EDGE[5][1])]])
    assert got == {(None if i == 1 << 63 else i): v for i, v in want.items()}


def test_repeated_rows_do_not_remove_each_other(spark):
    text = " ".join(f"t{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_removed"]) for r in substring_dedup.dedup_windows(docs).collect()) == [(1, 0), (1, 0), (2, 80)]
    assert sorted((r["doc_id"], r["n_removed"]) for r in suffix_index.dedup_bytes(docs).collect()) == [(1, 0), (1, 0), (2, len(text))]


def test_level_family_reports_each_shared_entry_once_and_merges_levels():
    family = suffix_index.LevelFamily()
    rng = np.random.default_rng(1)
    seen, told = {}, set()
    want = set()
    for text in range(40):
        q = np.unique(rng.integers(0, 400, 20)).astype(np.uint64)
        owner, pos = family.add(q, np.full(len(q), text), np.arange(len(q)))
        told |= set(owner.tolist())
        for v in q.tolist():
            seen.setdefault(v, set()).add(text)
    for texts in seen.values():
        if len(texts) > 1:
            want |= texts
    assert told == want
    assert len(family.levels) <= 8


def test_small_parts_and_buckets_give_the_same_result(spark, small, small_rows, monkeypatch):
    from rawmart.llm import repeats

    monkeypatch.setattr(repeats, "BUCKET_BYTES", 5000)
    assert _by_id(suffix_index.dedup_bytes(small), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.byte_dedup(small_rows)


def test_thinned_edges_have_the_same_components(spark):
    # 40 hubs that 500 nodes have in common: an edge a node, not one for each hub
    import random

    from rawmart.llm.components import components, thinned

    draw = random.Random(5)
    pairs = [(hub, node) for node in range(100, 600) for hub in range(40)] + [(700 + draw.randrange(30), 800 + draw.randrange(60)) for _ in range(50)]
    edges = spark.createDataFrame(pairs, "x long, y long")
    few = thinned(edges)
    assert few.count() <= 500 + 40 + 100
    both = [sorted((r["node"], r["label"]) for r in components(e).collect()) for e in (edges, few)]
    assert both[0] == both[1]


def test_places_found_by_bucket_are_few_rows(spark, monkeypatch):
    # each text shares a passage with one other: its places lie in all 20 buckets, but a row is no text in one bucket
    import random

    from rawmart.llm import repeats

    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    passages = [" ".join(word() for _ in range(240)) for _ in range(150)]
    rows = [(i, f"{word()} {passages[i % 150]} {word()}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(30)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 30_000)
    for module, run, want in ((suffix_index, suffix_index.dedup_bytes, brute.byte_dedup), (substring_dedup, substring_dedup.dedup_windows, brute.window_dedup)):
        counts = []

        def counted(found, gather=module.gathered, counts=counts):
            counts.append(found.count())
            return gather(found)

        monkeypatch.setattr(module, "gathered", counted)
        got = _by_id(run(docs), *(("n_bytes", "n_removed", "n_spans", "kept_sha256") if module is suffix_index else ("n_words", "n_removed", "kept_sha256")))
        assert got == want(rows) and sum(v[1] for v in got.values()) > 150 * 200
        assert max(counts) <= 1500


def test_forest_of_a_bucket_has_no_long_paths():
    import pyarrow as pa

    n = 200
    same = {c: pa.array([1] * n, pa.int64()) for c in ("key", "i", "j", "own", "l0", "l1", "l2", "l3")}
    ids = pa.array(range(10, 10 + n), pa.int64())
    rows = pa.RecordBatch.from_pydict({**same, "id": ids, "label": ids, "n": pa.array([100] * n, pa.int64()), "full": pa.array([80] * n, pa.int32())})
    out = list(hyperminhash._forests(iter([rows]), pa.schema([("x", pa.int64()), ("y", pa.int64())]), 85))
    pairs = [(x, y) for b in out for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)]
    assert sorted(pairs) == [(10, y) for y in range(11, 10 + n)]


def test_labels_are_written_by_few_tasks(spark, monkeypatch):
    from rawmart.llm import components as module
    from rawmart.session import session_conf

    files = {}

    def counted(df, name, scratch=module.scratch):
        out = scratch(df, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(module, "scratch", counted)
    edges = [(i, i + 1) for i in range(400) if i % 40] + [(7, 7)]
    with session_conf(spark, {"spark.sql.shuffle.partitions": "90", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {i: (i - 1) // 40 * 40 + 1 for i in range(1, 401)}
    assert files["labels"] <= spark.sparkContext.defaultParallelism + 1


def test_joined_components(spark):
    from rawmart.llm.components import joined

    frame = lambda rows: spark.createDataFrame(rows, "node long, label long")
    found = frame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)])
    tops = frame([(1, 1), (5, 1), (3, 3), (4, 3)])  # 3 and 4 had no edge
    got = sorted((r["node"], r["label"]) for r in joined(found, tops).collect())
    assert got == [(1, 1), (2, 1), (3, 3), (4, 3), (5, 1), (6, 1), (8, 8), (9, 8)]


def test_rows_of_one_id_join_what_their_texts_link(spark):
    words = lambda name, odd=None: " ".join(odd if odd and i == 0 else f"{name}{i}" for i in range(60))
    rows = [(4, words("a")), (4, words("b")), (7, words("a", "x")), (2, words("b", "y")), (9, words("c")), (None, words("a")), (4, None)]
    got = sorted((r["doc_id"], r["component_id"]) for r in hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect() if r["doc_id"] is not None and r["n_shingles"])
    assert got == [(2, 2), (4, 2), (4, 2), (7, 2), (9, 9)]
