"""Strings that collide in polynomials modulo a power of two (the Thue-Morse word and its complement) stay apart."""

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest

from rawmart.llm import decontam, hyperminhash, langid, repeats, sentence_pieces, substring_dedup, suffix_index, text
from rawmart.llm.queries import PIECE_MODEL

BITS = [bin(i).count("1") % 2 for i in range(2048)]


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[x] for x in BITS[:n])


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("n", [256, 512, 1024, 2048])
def test_hashes_differ(n):
    rows = pa.array([thue_morse(n), thue_morse(n, "b", "a")])
    chunk = next(text.chunks(rows, 1 << 20))
    found = text.words(chunk)
    a, b = text.word_hashes(chunk, found)
    assert a != b
    starts = np.array([0, n])
    x, y = text.window_hash(chunk.data, starts, starts + n)
    assert x != y
    u, v = suffix_index.NearHash(chunk.data)(starts, starts + n)
    assert u != v


def test_window_hash_depends_on_content_and_length_only():
    rng = np.random.default_rng(7)
    values = rng.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2)
    values[100:150], values[200:250] = values[:50], values[:50]
    starts = np.array([0, 100, 200, 0, 100, 1])
    ends = np.array([50, 150, 250, 49, 149, 50])
    h = text.window_hash(values, starts, ends)
    assert h[0] == h[1] == h[2] and h[3] == h[4] and len(set(h.tolist())) == 3


def test_products_modulo_the_prime():
    p = (1 << 61) - 1
    rng = np.random.default_rng(3)
    a, b = (np.concatenate([rng.integers(0, p, 500), [0, 1, p - 1]]).astype(np.uint64) for _ in range(2))
    assert text.times(a, b).tolist() == [int(x) * int(y) % p for x, y in zip(a, b, strict=True)]
    assert text.powers(12345, 300).tolist() == [pow(12345, i, p) for i in range(301)]


def test_run_hash_by_brute_force_equality():
    rng = np.random.default_rng(5)
    words = ["".join("ab"[x] for x in rng.integers(0, 2, rng.integers(1, 5))) for _ in range(400)]
    chunk = next(text.chunks(pa.array([" ".join(words)]), 1 << 20))
    h = text.word_hashes(chunk, text.words(chunk))
    assert len(set(h.tolist())) == len(set(words)) and len({(w, x) for w, x in zip(words, h.tolist(), strict=True)}) == len(set(words))


def colliding_rows():
    a, b = thue_morse(1024), thue_morse(1024, "b", "a")
    tail = " ".join(f"w{i}" for i in range(49))
    return [(1, f"{a} x y"), (2, f"{b} x y"), (3, f"{a} {tail}"), (4, f"{b} {tail}"), (5, f"{a} {tail}")]


def test_near_duplicates(spark):
    rows = colliding_rows()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in hyperminhash.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert got == brute.near_duplicates(rows, 3, 85) and got[2][1] == 2


def test_windows(spark):
    rows = colliding_rows()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.dedup_windows(frame(spark, rows)).collect()}
    assert got == brute.window_dedup(rows) and got[4][1] == 0 and got[5][1] == 50


def test_bytes(spark):
    rows = colliding_rows()[:4]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_index.dedup_bytes(frame(spark, rows)).collect()}
    assert got == brute.byte_dedup(rows)


def test_long_byte_strings_are_compared_soundly(spark):
    rows = [(1, thue_morse(1024) + "x"), (2, thue_morse(1024, "b", "a") + "x")]
    got = {r["doc_id"]: r["n_removed"] for r in suffix_index.dedup_bytes(frame(spark, rows), 1024).collect()}
    assert got == {1: 0, 2: 0}


def test_leaks(spark):
    a, b = thue_morse(1024), thue_morse(1024, "b", "a")
    tail = "one two three four five six seven"
    items = spark.createDataFrame([(0, f"{a} {tail}")], "item_id long, text string")
    found = decontam.find_leaks(frame(spark, [(1, f"{b} {tail}"), (2, f"{a} {tail}")]), items).collect()
    assert [r["doc_id"] for r in found] == [2]


def test_pieces_are_lossless(spark):
    rows = [(1, "A" + thue_morse(1024)), (2, "A" + thue_morse(1024, "b", "a")), (3, f"{thue_morse(1024)} {thue_morse(1024, 'b', 'a')}")]
    out = sentence_pieces.round_trip(frame(spark, rows), PIECE_MODEL).collect()
    assert {r["doc_id"]: r["decoded"] for r in out} == dict(rows)


def test_units_of_equal_hash_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(text, "run_hash", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    chunk = next(text.chunks(pa.array(["ab cd ab", " ef ab cd"]), 1 << 20))
    own = sentence_pieces.units(chunk)
    shown, which = text.distinct(chunk.data, own.starts, own.ends)
    raw = chunk.data.tobytes()
    unit = lambda i: raw[own.starts[i] : own.ends[i]]
    assert [unit(shown[w]) for w in which] == [unit(i) for i in range(len(own.starts))]


def test_texts_that_share_one_of_two_hashes_get_names_of_their_own(spark):
    rows = spark.createDataFrame([(1, 7, 1, "a"), (2, 7, 2, "b"), (3, 8, 3, "c"), (4, 7, 1, "a")], "id long, c1 long, c2 long, text string")
    rows, keys, classes, _ = repeats.text_classes(rows, "test")
    names = {r["c2"]: r["c1"] for r in classes.collect()}
    assert len(set(names.values())) == 3 and names[3] == 8
    for df in (rows, keys):
        assert all(names[r["c2"]] == r["c1"] for r in df.collect()) and df.count() == 4


def test_marks_alone_are_no_language(spark):
    model = langid.fit(spark.createDataFrame([("en", "the house is old"), ("es", "la casa es vieja")], "lang string, text string"))
    rows = [(1, "\u0301\u0301"), (2, "\U00030010"), (3, "1 2 \u0301 a"), (4, "")]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(frame(spark, rows), model).collect()}
    assert got[1] == got[4] == ("und", 0.0) and got[2][0] != "und" and got[3][0] != "und"
