"""Periodic run detection on grammar-compressed word sequences.

A run is a stretch of words that repeats with a period and can't be made longer with it. Re-Pair compresses the word ids: the
most frequent pair of symbols becomes a nonterminal, as long as a pair repeats; what is left is joined by a balanced tree.
A run of the text lies inside the expansion of one symbol and crosses the boundary between its two parts. So the runs that cross
a boundary are computed once for each nonterminal, moved to all places where it is derived, and merged where they overlap.

Only stretches that can hold a run are compressed: a run of at least ``min_length`` words and ``min_exponent`` periods less its
period has at least ``min_length * (min_exponent - 1) / min_exponent`` words, and all of them occur again one period on. So
every word of a run lies in a window of that size that its text has twice. Windows are found by hash, runs by the word ids.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .substring_dedup import joined_words
from .text import arrow_schema, batch, chunks, distinct, gram_starts, list_array, mix, pick, tidy, window_hash, words

_U = np.uint64


def re_pair(ids: list[int]) -> tuple[list[tuple[int, int]], list[int]]:
    """Rules and the compressed sequence. Symbol ``k + i`` is rule i = (left, right), where k is the number of ids; ids are below k."""
    n, base = len(ids), max(ids, default=-1) + 1
    sym, before, after = list(ids), list(range(-1, n - 1)), list(range(1, n + 1))
    places: dict[tuple[int, int], list[int]] = {}
    for i in range(n - 1):
        places.setdefault((ids[i], ids[i + 1]), []).append(i)
    count = {pair: len(at) for pair, at in places.items()}
    # equal counts: the oldest pair first, so that long repeats are paired up level by level
    birth = len(count)
    heap = [(-c, i, pair) for i, (pair, c) in enumerate(count.items()) if c > 1]
    heapq.heapify(heap)
    rules: list[tuple[int, int]] = []
    while heap:
        c, born, pair = heapq.heappop(heap)
        now = count.get(pair, 0)
        if now < 2:
            continue
        if now != -c:  # it lost places to other pairs since
            heapq.heappush(heap, (-now, born, pair))
            continue
        a, b = pair
        new = base + len(rules)
        fresh: dict[tuple[int, int], None] = {}
        used = False
        for p in places.pop(pair):
            if sym[p] != a:
                continue
            q = after[p]
            if q >= n or sym[q] != b:
                continue
            used = True
            left, right = before[p], after[q]
            sym[p], sym[q], after[p] = new, -1, right
            if left >= 0:
                old, made = (sym[left], a), (sym[left], new)
                if old in count:
                    count[old] -= 1
                places.setdefault(made, []).append(left)
                count[made] = count.get(made, 0) + 1
                fresh[made] = None
            if right < n:
                before[right] = p
                old, made = (b, sym[right]), (new, sym[right])
                if old in count:
                    count[old] -= 1
                places.setdefault(made, []).append(p)
                count[made] = count.get(made, 0) + 1
                fresh[made] = None
        count.pop(pair, None)
        if used:
            rules.append(pair)
        for made in fresh:
            if count.get(made, 0) > 1:
                heapq.heappush(heap, (-count[made], birth, made))
                birth += 1
    return rules, [s for s in sym if s >= 0]


def _same_ahead(w: np.ndarray, i: int, j: int, limit: int) -> int:
    """How many of w[i], w[i + 1], ... equal w[j], w[j + 1], ..., up to ``limit``."""
    done, step = 0, 32
    while done < limit:
        m = min(step, limit - done)
        other = w[i + done : i + done + m] != w[j + done : j + done + m]
        k = int(other.argmax())
        if other[k]:
            return done + k
        done, step = done + m, step * 4
    return done


def _same_behind(w: np.ndarray, i: int, j: int, limit: int) -> int:
    """How many of w[i - 1], w[i - 2], ... equal w[j - 1], w[j - 2], ..., up to ``limit``."""
    done, step = 0, 32
    while done < limit:
        m = min(step, limit - done)
        other = (w[i - done - m : i - done] != w[j - done - m : j - done])[::-1]
        k = int(other.argmax())
        if other[k]:
            return done + k
        done, step = done + m, step * 4
    return done


class Boundary:
    """Runs that cross a place of a sequence, inside an interval around it."""

    def __init__(self, w: np.ndarray, min_length: int, min_exponent: int):
        self.w, self.min_length, self.min_exponent = w, min_length, min_exponent
        # a run has so many words or more that equal those one period on; half of them or more on one side of the place
        self.size = (window_size(min_length, min_exponent) + 1) // 2
        starts = np.arange(max(len(w) - self.size + 1, 0))
        self.grams = window_hash(w, starts, starts + self.size)

    def periods(self, low: int, b: int, high: int) -> tuple[set[int], set[int]]:
        """Candidate periods: equal windows a period apart, right after or before b and b + q, or b - q and b."""
        most, k, g = (high - low) // self.min_exponent, self.size, self.grams
        right: set[int] = set()
        left: set[int] = set()
        if b + k <= high:
            right.update((np.flatnonzero(g[b + 1 : min(b + most, high - k) + 1] == g[b]) + 1).tolist())
            left.update((np.flatnonzero(g[max(b - most, low) : b][::-1] == g[b]) + 1).tolist())
        if b - k >= low:
            at = b - k
            right.update((np.flatnonzero(g[at + 1 : min(at + most, high - k) + 1] == g[at]) + 1).tolist())
            left.update((np.flatnonzero(g[max(at - most, low) : at][::-1] == g[at]) + 1).tolist())
        return right, left

    def crossing(self, low: int, b: int, high: int) -> list[tuple[int, int, int]]:
        """(start, end, period) of runs inside [low, high) that hold b - 1 and b."""
        w, out = self.w, []
        right, left = self.periods(low, b, high)
        # A period q' is settled by a stretch around b with period q that has q' + q words after b (or before it, on the other
        # side): a multiple of q is no smallest period there. Any other q' matches less than q words on that side, so its run, if
        # it has three periods, reaches q' words to the other side too, where it is found as well.
        settled: list[tuple[int, int, int]] = []
        for q in sorted(right | left):
            skip = [(q <= r, q <= l) for p, r, l in settled if self.min_exponent > 2 or q % p == 0]
            found = []
            if q in right and not any(r for r, _ in skip):
                found.append((b - _same_behind(w, b, b + q, b - low), b + q + _same_ahead(w, b, b + q, high - b - q)))
            if q in left and not any(l for _, l in skip):
                found.append((b - q - _same_behind(w, b - q, b, b - q - low), b + _same_ahead(w, b - q, b, high - b)))
            for start, end in found:
                if end - start < 2 * q:
                    continue
                settled.append((q, end - b - q, b - start - q))
                if start < b < end and end - start >= max(self.min_length, self.min_exponent * q):
                    out.append((start, end, q))
        return out


def window_size(min_length: int, min_exponent: int) -> int:
    return -(-min_length * (min_exponent - 1) // min_exponent)


def find_runs(ids: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of all runs of a sequence of word ids, by start, then period."""
    _, ids = np.unique(ids, return_inverse=True)
    rules, rest = re_pair(ids.tolist())
    base = int(ids.max()) + 1 if len(ids) else 0
    length = [1] * base
    for a, b in rules:
        length.append(length[a] + length[b])
    at: dict[int, list[int]] = {}  # places of each nonterminal that is long enough to hold a run
    tops, place = [], 0
    for s in rest:
        tops.append((place, place + length[s]))
        stack = [(s, place)]
        while stack:
            x, p = stack.pop()
            if length[x] >= min_length and x >= base:
                at.setdefault(x, []).append(p)
                a, b = rules[x - base]
                stack += [(a, p), (b, p + length[a])]
        place += length[s]
    boundary = Boundary(ids, min_length, min_exponent)
    found: dict[int, set[tuple[int, int]]] = {}
    for x, starts in at.items():
        p = starts[0]
        for start, end, q in boundary.crossing(p, p + length[rules[x - base][0]], p + length[x]):
            found.setdefault(q, set()).update((start - p + o, end - p + o) for o in starts)
    while len(tops) > 1:  # the tree over what is left; each of its symbols occurs once
        level = []
        for (low, b), (_, high) in zip(tops[::2], tops[1::2], strict=False):
            level.append((low, high))
            if high - low >= min_length:
                for start, end, q in boundary.crossing(low, b, high):
                    found.setdefault(q, set()).add((start, end))
        tops = level + tops[len(level) * 2 :]
    out: list[tuple[int, int, int]] = []
    for q in sorted(found):
        merged: list[list[int]] = []
        for start, end in sorted(found[q]):
            if merged and start + q <= merged[-1][1]:  # they share a period, so they are one
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        # inside a run of a smaller period, q is only a multiple of that period
        smaller = np.array(sorted(out), dtype=np.int64).reshape(-1, 3)
        reach = np.maximum.accumulate(smaller[:, 1]) if len(out) else smaller[:, 1]
        for start, end in merged:
            k = int(np.searchsorted(smaller[:, 0], start, "right"))
            if not k or reach[k - 1] < end:
                out.append((start, end, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _stretches(ids: np.ndarray, first: np.ndarray, row: np.ndarray, min_length: int, size: int) -> list[tuple[int, int]]:
    """Where runs can be: stretches of words, each inside a row, that windows cover which their row has twice."""
    starts, of = gram_starts(first, size)
    key = mix(window_hash(ids, starts, starts + size) ^ mix(of.astype(_U) + _U(1)))
    order = np.argsort(key)
    twice = np.zeros(len(key), dtype=bool)
    if len(key):
        same = key[order[1:]] == key[order[:-1]]
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
    mark = np.zeros(len(ids) + 1, dtype=np.int32)
    mark[starts[twice]] += 1
    mark[starts[twice] + size] -= 1
    inside = np.cumsum(mark[:-1]) > 0
    opens, closes = inside.copy(), inside.copy()
    if len(ids):
        other = row[1:] != row[:-1]
        opens[1:] &= ~inside[:-1] | other
        closes[:-1] &= ~inside[1:] | other
    return [(a, b) for a, b in zip(np.flatnonzero(opens).tolist(), (np.flatnonzero(closes) + 1).tolist(), strict=True) if b - a >= min_length]


@tidy
def _collapse(batches: Iterator[pa.RecordBatch], schema: pa.Schema, min_length: int, min_exponent: int) -> Iterator[pa.RecordBatch]:
    size = window_size(min_length, min_exponent)
    run_type = schema.field("runs").type
    for rows in batches:
        for chunk in chunks(rows.column("text")):
            w = words(chunk)
            _, ids = distinct(chunk.data, w.starts, w.ends)
            m = chunk.last - chunk.first
            kept = np.ones(len(ids), dtype=bool)
            own: list[tuple[int, int, int, int]] = []  # row, start, length, period
            for a, b in _stretches(ids, w.first, w.row, min_length, size):
                row = int(w.row[a])
                for start, end, q in find_runs(ids[a:b], min_length, min_exponent):
                    kept[a + start + q : a + end] = False
                    own.append((row, a + start - int(w.first[row]), end - start, q))
            columns = np.array(own, dtype=np.int64).reshape(-1, 4)
            spans = pa.StructArray.from_arrays([pa.array(columns[:, c]) for c in (1, 2, 3)], fields=list(run_type.value_type))
            yield batch(
                schema, id=rows.column("id").slice(chunk.first, m), n_words=np.diff(w.first).astype(np.int64), runs=list_array(spans, np.bincount(columns[:, 0], minlength=m)).cast(run_type),
                collapsed=pa.array([t.decode() for t in joined_words(chunk, w, kept)], pa.string()),
            )


def collapse_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row for each row of ``docs``: doc_id, n_words, runs (array of start, length, period in words; by start, then period), collapsed.

    A run is a maximal stretch of words (between white space, compared as they are) with a smallest period q of which it has
    ``min_length`` words and ``min_exponent`` periods, or more. ``collapsed`` has the words that are in the first period of each
    run they are in, or in none, joined by one space. A null or blank text has no words, no runs, and collapses to the empty
    text. Each row is judged alone: repeated rows give equal rows, ids may be null. Whole texts are read; memory holds the words
    of CHUNK_BYTES of text, or of the longest text.
    """
    if min_exponent < 2 or min_length < min_exponent:
        raise ValueError("min_exponent must be at least 2, and min_length at least min_exponent")
    rows = pick(docs, id=id_col, text=text_col)
    ddl = f"id {rows.schema['id'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    schema = arrow_schema(ddl)
    return rows.mapInArrow(lambda b: _collapse(b, schema, min_length, min_exponent), ddl).withColumnRenamed("id", "doc_id")
