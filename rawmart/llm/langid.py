"""Language identification of mixed-language text: script ranges narrow the candidates of a word, per-word scores come from
byte trigrams, and a Viterbi path with a switching penalty labels spans of words.

The model is trained with Spark: each task counts the trigrams of its rows by language, the counts are summed by language
and slot, and at most languages * (SLOTS + scripts) sums reach the driver, however large the corpus is. Every labelled row
is read; there is no sample.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import arrow_schema, batch, bound_batches, byte_class, chunks, list_array, LOWER, pick, tidy, words

SLOT_BITS = 15
SLOTS = 1 << SLOT_BITS
#: Unicode ranges of scripts; letters outside them are of script 0
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)],
}
ASCII_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
#: a language is a candidate for words of a script if it has this share of its words, or more, in it
MIN_SCRIPT_SHARE = 0.01
#: words whose scores are kept at a time
VITERBI_WORDS = 400_000

_tables: list[np.ndarray] = []


def _code_points() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, whether it is a letter or a mark, and its script's number."""
    if not _tables:
        kind = np.array([unicodedata.category(chr(c))[0] for c in range(0x110000)])
        script = np.zeros(0x110000, dtype=np.uint8)
        for number, spans in enumerate(SCRIPTS.values(), 1):
            for a, b in spans:
                script[a : b + 1] = number
        _tables[:] = [kind == "L", (kind == "L") | (kind == "M"), script]
    return _tables[0], _tables[1], _tables[2]


@dataclass
class LetterWords:
    """Words (runs of letters and marks, in rows with a letter) of a chunk: slots of all their bytes, where each word's bytes start, first word of each row, script, bytes."""

    slots: np.ndarray
    heads: np.ndarray
    first: np.ndarray
    script: np.ndarray
    size: np.ndarray


def letter_words(chunk) -> LetterWords:
    data = LOWER[chunk.data]
    inside = ASCII_LETTER[chunk.data]
    letters = inside.copy()
    script_at = np.ones(len(data), dtype=np.uint8)  # latin is number 1
    wide = np.flatnonzero(data >= 0x80)
    if len(wide):
        letter, part, script = _code_points()
        lead = data[wide]
        start = lead >= 0xC0
        at = wide[start]
        b = [data[np.minimum(at + k, len(data) - 1)].astype(np.int32) & 0x3F for k in range(4)]
        head = data[at].astype(np.int32)
        cp = np.where(head < 0xE0, (head & 0x1F) << 6 | b[1], np.where(head < 0xF0, (head & 0x0F) << 12 | b[1] << 6 | b[2], (head & 0x07) << 18 | b[1] << 12 | b[2] << 6 | b[3]))
        char = np.maximum(np.cumsum(start) - 1, 0)  # of each wide byte
        if len(at):
            letters[wide] = letter[cp][char]
            inside[wide] = part[cp][char]
            script_at[wide] = script[cp][char]
    seen = np.concatenate([[0], np.cumsum(letters)])[chunk.offsets]
    inside &= np.repeat(np.diff(seen) > 0, np.diff(chunk.offsets))
    table = inside.view(np.uint8)
    marked = type(chunk)(chunk.first, chunk.last, table, chunk.offsets)
    found = words(marked, np.array([False, True] + [False] * 254))
    padded = np.where(inside, data, np.uint8(0x20)).astype(np.uint32)
    before, after = np.empty_like(padded), np.empty_like(padded)
    if len(padded):
        before[1:], before[0] = padded[:-1], 0x20
        after[:-1], after[-1] = padded[1:], 0x20
        before[found.starts] = 0x20
        after[found.ends - 1] = 0x20
    packed = (before << np.uint32(16) | padded << np.uint32(8) | after)[inside]
    slots = (packed * np.uint32(0x9E3779B1) >> np.uint32(32 - SLOT_BITS)).astype(np.int32)
    size = found.ends - found.starts
    return LetterWords(slots, np.cumsum(size) - size, found.first, script_at[found.starts], size)


@tidy
def _count(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for rows in batches:
        langs = np.array(rows.column("lang").to_pylist(), dtype=object)
        for chunk in chunks(rows.column("text")):
            w = letter_words(chunk)
            names = langs[chunk.first : chunk.last]
            byte_rows = np.repeat(np.arange(len(names)), np.diff(np.append(w.heads, len(w.slots))[w.first]))
            word_rows = np.repeat(np.arange(len(names)), np.diff(w.first))
            for name in dict.fromkeys(names):
                own = names == name
                total = sums.setdefault(name, np.zeros(SLOTS + len(SCRIPTS) + 1, dtype=np.int64))
                total[:SLOTS] += np.bincount(w.slots[own[byte_rows]], minlength=SLOTS)
                total[SLOTS:] += np.bincount(w.script[own[word_rows]], minlength=len(SCRIPTS) + 1)
    for name, total in sums.items():
        slots = np.flatnonzero(total)
        yield batch(schema, lang=pa.array([name] * len(slots), pa.string()), slot=slots.astype(np.int32), n=total[slots])


@dataclass
class LanguageModel:
    langs: list[str]
    scores: np.ndarray  # log probability by language and slot
    allowed: np.ndarray  # by script and language


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", alpha: float = 0.5) -> LanguageModel:
    """Model of all rows with a language and a text. No such rows: a model without languages, which predicts ``und`` everywhere."""
    ddl = "lang string, slot int, n long"
    schema = arrow_schema(ddl)
    rows = pick(labelled, lang=lang_col, text=text_col).where("lang is not null and text is not null")
    counted = rows.mapInArrow(lambda b: _count(b, schema), ddl).groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(counted.column("lang").to_pylist()))
    counts = np.zeros((len(langs), SLOTS + len(SCRIPTS) + 1))
    if langs:
        at = np.array([langs.index(x) for x in counted.column("lang").to_pylist()])
        counts[at, counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    grams, scripts = counts[:, :SLOTS] + alpha, counts[:, SLOTS:]
    scores = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32) if langs else grams
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    allowed = share.T >= MIN_SCRIPT_SHARE
    allowed[~allowed.any(axis=1)] = True  # a script that no language was seen in excludes none
    return LanguageModel(langs, scores, allowed)


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Language of each word on the best path of each row: the sum of the words' scores less ``penalty`` for each switch.

    Words of row i: first[i] .. first[i + 1]. All rows step at once, the longest first in order. Ties keep the language.
    """
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begin, counts = first[:-1][order], counts[order]
    n, langs = scores.shape
    switched, came = np.zeros((n, langs), dtype=bool), np.zeros(n, dtype=np.int8 if langs < 128 else np.int32)
    label = np.zeros(n, dtype=came.dtype)
    longest = int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(longest), "left")  # rows with more than t words
    value = np.zeros((int(active[0]) if longest else 0, langs))
    last = np.zeros(len(value), dtype=came.dtype)
    for t in range(longest):
        a = active[t]
        if a < len(value):
            last[a : len(value)] = value[a:].argmax(axis=1)
            value = value[:a]
        at = begin[:a] + t
        if t:
            best = value.argmax(axis=1)
            jump = value[np.arange(a), best][:, None] - penalty
            came[at] = best
            switched[at] = jump > value
            value = np.maximum(value, jump)
        value = value + scores[at]
        value -= value.max(axis=1, keepdims=True)
    if longest:
        last[: len(value)] = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        at, now = begin[: active[t]] + t, last[: active[t]]
        label[at] = now
        last[: active[t]] = np.where(switched[at, now], came[at], now)
    return label


_SPAN = "array<struct<lang:string,first:int,last:int>>"


def _label(batches: Iterator[pa.RecordBatch], span_type: pa.DataType, model: LanguageModel, penalty: float, at: int) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray, pa.Array]]:
    """Rows (with the text as column number ``at``) with their language, score and spans; up to VITERBI_WORDS words step together."""
    langs = len(model.langs)
    name = np.array([*model.langs, "und"], dtype=object)

    def flush(kept: list) -> Iterator[tuple]:
        scores, counts, size = (np.concatenate([k[c] for k in kept]) for c in (1, 2, 3))
        first = np.concatenate([[0], np.cumsum(counts)])
        row = np.repeat(np.arange(len(counts)), counts)
        label = viterbi(scores, first, penalty)
        weight = np.bincount(row * langs + label, weights=size, minlength=len(counts) * langs).reshape(-1, langs)
        total = weight.sum(axis=1)
        winner = np.where(total > 0, weight.argmax(axis=1), langs)
        score = np.where(total > 0, weight.max(axis=1) / np.maximum(total, 1), 0.0)
        head = np.ones(len(label), dtype=bool)
        head[1:] = (label[1:] != label[:-1]) | (row[1:] != row[:-1])
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], len(label))
        spans = pa.StructArray.from_arrays(
            [pa.array(name[label[heads]], pa.string()), pa.array(heads - first[row[heads]], pa.int32()), pa.array(tails - 1 - first[row[heads]], pa.int32())],
            fields=list(span_type.value_type),
        )
        spans = list_array(spans, np.bincount(row[heads], minlength=len(counts))).cast(span_type)
        lang = pa.array(name[winner], pa.string())
        done = 0
        for rows, *_ in kept:
            own = slice(done, done + rows.num_rows)
            yield rows, lang.slice(done, rows.num_rows), score[own], spans.slice(done, rows.num_rows)
            done += rows.num_rows

    kept, n = [], 0
    for whole in batches:
        for chunk in chunks(whole.column(at)):
            rows = whole.slice(chunk.first, chunk.last - chunk.first)
            if not langs:
                m = rows.num_rows
                yield rows, pa.array(["und"] * m, pa.string()), np.zeros(m), pa.array([[]] * m, span_type)
                continue
            w = letter_words(chunk)
            scores = np.stack([np.add.reduceat(s[w.slots], w.heads) if len(w.heads) else np.zeros(0, np.float32) for s in model.scores], axis=1)
            scores = np.where(model.allowed[w.script], scores, np.float32(-1e4))
            scores -= scores.max(axis=1, keepdims=True) if len(scores) else 0
            kept.append((rows, scores, np.diff(w.first), w.size))
            n += len(scores)
            if n >= VITERBI_WORDS:
                yield from flush(kept)
                kept, n = [], 0
    if kept:
        yield from flush(kept)


def identify(docs: DataFrame, model: LanguageModel, penalty: float = 12.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row for each row of ``docs``: doc_id, lang_pred, score, spans (array of lang, first, last: words of letters, from 0).

    ``lang_pred`` has the most bytes of letters on the best path (ties: the first by name), ``score`` is their share. A null
    text, or one without a letter, gives ``und``, score 0 and no spans. ``penalty``: what a switch of language costs, in
    nats. Repeated rows give repeated rows; ids may be null. Whole texts are read; the scores of the longest text, or of
    VITERBI_WORDS words, are held at a time.
    """
    rows = pick(docs, id=id_col, text=text_col)
    ddl = f"id {rows.schema['id'].dataType.simpleString()}, lang string, score double, spans {_SPAN}"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, lang, score, spans in _label(batches, schema.field("spans").type, model, penalty, 1):
            yield batch(schema, id=own.column(0), lang=lang, score=score, spans=spans)

    found = rows.mapInArrow(tidy(run), ddl)
    return found.select(F.col("id").alias("doc_id"), F.col("lang").alias("lang_pred"), "score", "spans")


def tag(docs: DataFrame, model: LanguageModel, penalty: float = 12.0, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, by position, then lang_pred and score as in ``identify``."""
    bound_batches(docs.sparkSession)
    names = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    at = names.index(text_col)
    ddl = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in flat.schema), "lang_pred string", "score double"])
    schema, span_type = arrow_schema(ddl), arrow_schema(f"spans {_SPAN}").field("spans").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, lang, score, _ in _label(batches, span_type, model, penalty, at):
            yield pa.RecordBatch.from_arrays([*own.columns, lang, pa.array(score)], schema=schema)

    return flat.mapInArrow(tidy(run), ddl).toDF(*names, "lang_pred", "score")
