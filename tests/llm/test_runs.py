import random
from fractions import Fraction

import llm_brute as brute
import numpy as np
import pytest
from llm_rows import prose

from rawmart.llm import queries, runs


def direct(words, min_length=24, min_exponent=3):
    """All maximal stretches of each period; of equal stretches the smallest period."""
    n, best = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_exponent * q):
                best.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def made(rng):
    out = []
    for _ in range(rng.randint(1, 6)):
        if rng.random() < 0.35:
            out += [rng.randint(0, rng.choice([1, 2, 3, 10, 100])) for _ in range(rng.randint(1, 40))]
        else:
            part = [rng.randint(0, rng.choice([1, 2, 5, 50])) for _ in range(rng.randint(1, 15))] * rng.randint(2, 9)
            out += part[: rng.randint(1, len(part))]
    return out


@pytest.mark.parametrize("min_length, min_exponent", [(24, 3), (6, 2), (3, 3), (10, 2), (12, 4)])
def test_runs_match_brute_force(min_length, min_exponent):
    rng = random.Random(min_length)
    total = 0
    for _ in range(1500):
        words = made(rng)
        want = direct(words, min_length, min_exponent)
        total += len(want)
        assert runs.find_runs(np.array(words), min_length, min_exponent) == want, words
    assert total > 300


def test_highly_repetitive_sequences():
    a, b = "0", "01"
    while len(b) < 3000:
        a, b = b, b + a
    for words in ([1] * 700, [int(c) for c in b[:900]], list(range(30)) * 20, ([1] * 9 + [2]) * 40, [bin(i).count("1") % 2 for i in range(800)]):
        assert runs.find_runs(np.array(words), 24, 3) == direct(words)


def test_re_pair_expands_to_its_input():
    rng = random.Random(2)
    for _ in range(300):
        ids = np.unique(np.array(made(rng)), return_inverse=True)[1].tolist()
        rules, rest = runs.re_pair(ids)
        base = max(ids) + 1

        def expand(s):
            return [s] if s < base else expand(rules[s - base][0]) + expand(rules[s - base][1])  # noqa: B023

        assert [x for s in rest for x in expand(s)] == ids
        pairs = list(zip(rest, rest[1:], strict=False))
        assert all(pairs.count(p) == 1 for p in pairs if p[0] != p[1])  # no pair is left that repeats


def contract(doc_id, text):
    words = brute.SPACE_WORD.findall(text or "")
    n, h = len(words), brute.crc(str(doc_id))
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = direct(words)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2])) if found else None
    top = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    return (len(found), *top, brute.sha(listed.encode()), brute.sha(" ".join(w for i, w in enumerate(words) if i not in gone).encode()))


def test_query_matches_the_contract(spark, small_rows, monkeypatch):
    rows = [*small_rows, (90001, "a b " * 40), (90002, None), (90003, " \t"), (90004, "x " * 500 + "y " * 30 + "x y z " * 9), (90005, "one")]
    rows += [(91000 + i, prose(3 * i + 1, i)) for i in range(40)]  # some of these get a period
    monkeypatch.setattr(queries, "documents", lambda spark, sf_dir: spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: tuple(r[c] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")) for r in queries.op13_runs(spark, "").collect()}
    want = {i: contract(i, t) for i, t in rows}
    assert got == want
    assert sum(w[0] > 0 for w in want.values()) > 10


def test_edge_rows(edge, empty):
    out = {r["doc_id"]: r for r in runs.collapse_runs(edge).collect()}
    assert len(out) == 21
    for i in (1, 2, 3):
        assert out[i]["n_words"] == 0 and out[i]["runs"] == [] and out[i]["collapsed"] == ""
    assert [tuple(r) for r in out[10]["runs"]] == [(0, 3000, 1)] and out[10]["collapsed"] == "word"
    assert out[None]["collapsed"] == out[6]["collapsed"]
    assert runs.collapse_runs(empty).count() == 0


def test_rows_side_by_side_form_no_run(spark):
    rows = [(i, "a b c d") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert all(r["runs"] == [] for r in runs.collapse_runs(docs).collect())


def test_long_text(spark):
    text = prose(4000, 3) + " " + " ".join(f"v{i}" for i in range(3000)) * 4 + " " + prose(500, 9)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    words = brute.SPACE_WORD.findall(text)
    got = runs.collapse_runs(docs).first()
    assert [tuple(r) for r in got["runs"]] == [(s, e - s, q) for s, e, q in runs.find_runs(np.unique(np.array(words), return_inverse=True)[1], 24, 3)]
    assert any(r["period"] == 2999 for r in got["runs"])
