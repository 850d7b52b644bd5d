"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a benchmark question whose values were changed keeps its template.
Windows of the templates are hash-joined between documents and items; a matched window votes for its item and diagonal, and
the values behind the placeholders have to be consistent there: equal values of the item have equal values in the document.

A text has four templates (FORMS): its lower-cased words as they are, and three with placeholders, of which the first two
depend on nothing but the words themselves. An item is measured in each form on its own, and the best one counts, so a name
that opens a sentence, what stands before a copy, and letter case can't hide it.

Before the join, documents' windows pass a bitmap of the items' window hashes. The bitmap has ``1 << BITMAP_BITS`` bits however
large the benchmark is; a larger benchmark only lets more windows through to the join, and never loses one.

Boilerplate that many documents and many items have is not joined window by window: an item can only be held by a document
that has one of the item's rarest windows (``_probes``), so those alone choose the pairs whose windows then meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .text import ALNUM, arrow_schema, batch, byte_class, chunks, gram_starts, list_array, LOWER, pick, ranges, run_hash, scratch, tidy, window_hash, words

_U = np.uint64
BITMAP_BITS = 22
#: words that are a unit after a number
UNITS = "m cm mm km kg g mg lb lbs oz l ml s ms min h hr hrs hour hours minute minutes second seconds day days week weeks month months year years mile miles foot feet inch inches meter meters metre metres kilometer kilometers gram grams kilogram kilograms liter liters litre litres degree degrees percent dollar dollars euro euros cent cents usd eur gb mb kb".split()
#: words that open sentences more often than they are names
COMMON = set(
    "a an the this that these those i you he she it we they my your his her its our their some any each every all both most many much few no not one two three four five six seven eight nine ten "
    "who whom whose what which when where why how if whether while because since until unless although though and or but so then than as at by for from in into of on onto off over under after before between during "
    "through to toward towards up down out with within without about above across against along among around is are was were be been am do does did has have had can could should would shall might must let there here "
    "now today tomorrow yesterday also however thus hence therefore suppose given find calculate compute determine evaluate solve write show prove explain choose select consider "
    "der die das den dem des ein eine einer eines einem einen und oder aber wenn wie was wer wo warum wann ist sind war in im am an auf aus bei mit nach von zu für es er sie wir ich "
    "le la les un une des et ou mais si que qui quoi comment pourquoi quand est sont dans en au aux avec pour sur il elle nous vous je "
    "el los las una unos unas y o pero cuando como donde por para con sin de del al es son".split()
)
FORMS = PLAIN, NUMBERS, INNER_NAMES, NAMES = range(4)
NUMBER, NAME, UNIT = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
_DIGIT, _UPPER = byte_class((0x30, 0x39)), byte_class((0x41, 0x5A))
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?:;\n\r\"")] = True


def _below(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place."""
    out = np.zeros(len(flags) + 1, dtype=np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def _lowered(data: np.ndarray) -> np.ndarray:
    """A-Z and the Latin-1 capitals in lower case."""
    low = LOWER[data]
    c3 = np.flatnonzero(data[:-1] == 0xC3) + 1
    c3 = c3[(data[c3] >= 0x80) & (data[c3] <= 0x9E) & (data[c3] != 0x97)]
    low[c3] += 32
    return low


def _word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return run_hash(_lowered(data), starts, ends)


def _hashes_of(listed) -> np.ndarray:
    encoded = [x.encode() for x in listed]
    ends = np.cumsum([len(x) for x in encoded])
    return np.sort(_word_hash(np.frombuffer(b"".join(encoded), dtype=np.uint8), ends - [len(x) for x in encoded], ends))


def templates(chunk, units: np.ndarray, common: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of a chunk's words: values of the templates by form, hashes of the words themselves, and the first word of each row.

    PLAIN has no placeholders, NUMBERS those of numbers and units. INNER_NAMES adds capitalised words that don't open a
    sentence, NAMES capitalised words that are not common, wherever they stand.
    """
    w = words(chunk, ALNUM)
    plain = _word_hash(chunk.data, w.starts, w.ends)
    size = w.ends - w.starts
    digits, upper, ends = _below(_DIGIT[chunk.data]), _below(_UPPER[chunk.data]), _below(_ENDS[chunk.data])
    number = digits[w.ends] - digits[w.starts] == size
    opens = np.ones(len(size), dtype=bool)  # begins a sentence
    opens[1:] = (ends[w.starts[1:]] > ends[w.ends[:-1]]) | (w.row[1:] != w.row[:-1])
    name = (upper[w.starts + 1] > upper[w.starts]) & (upper[w.ends] - upper[w.starts] == 1) & (size > 1) & (digits[w.ends] == digits[w.starts])
    rare = name.copy()
    rare[name] = ~np.isin(plain[name], common)
    unit = np.zeros(len(size), dtype=bool)
    after = np.flatnonzero(number[:-1] & (w.row[1:] == w.row[:-1])) + 1
    unit[after] = np.isin(plain[after], units)
    numbers = np.where(number, NUMBER, np.where(unit, UNIT, plain))
    named = lambda which: np.where(which & ~number & ~unit, NAME, numbers)
    return [plain, numbers, named(name & ~opens), named(rare)], plain, w.first


def _windows(values: list[np.ndarray], form: int, first: np.ndarray, size: int, literals: float):
    """Usable windows of ``size`` words of a form: start, row, hash. All of PLAIN are."""
    starts, rows = gram_starts(first, size)
    if form != PLAIN:
        fixed = _below(values[form] == values[PLAIN])
        good = fixed[starts + size] - fixed[starts] >= np.ceil(literals * size)
        starts, rows = starts[good], rows[good]
    return starts, rows, window_hash(values[form], starts, starts + size)


def _slots(value: np.ndarray, plain: np.ndarray, starts: np.ndarray, size: int) -> pa.Array:
    """Hashes of the words behind each window's placeholders, in order."""
    at = ranges(starts, np.full(len(starts), size))
    open_ = value[at] != plain[at]
    counts = open_.reshape(-1, size).sum(axis=1) if len(starts) else np.zeros(0, int)
    return list_array(pa.array(plain[at[open_]].view(np.int64)), counts)


def _of_items(batches: Iterator[pa.RecordBatch], schema: pa.Schema, size: int, literals: float) -> Iterator[pa.RecordBatch]:
    units, common = _hashes_of(UNITS), _hashes_of(COMMON)
    for rows in batches:
        ids, keys = rows.column("id"), rows.column("key")
        for chunk in chunks(rows.column("text")):
            values, plain, first = templates(chunk, units, common)
            n = np.diff(first)
            for form in FORMS:
                # a form that is an earlier one in all of an item's words adds nothing to that item
                new = np.ones(len(n), dtype=bool)
                for earlier in range(form):
                    differ = _below(values[form] != values[earlier])
                    new &= differ[first[1:]] > differ[first[:-1]]
                for k in sorted({int(x) for x in np.minimum(n, size) if x}):
                    starts, row, hashes = _windows(values, form, first, k, literals)
                    keep = (new & (np.minimum(n, size) == k))[row]
                    starts, row, hashes = starts[keep], row[keep], hashes[keep]
                    per = np.bincount(row, minlength=len(n))
                    at = pa.array(row + chunk.first)
                    yield batch(
                        schema, item_id=ids.take(at), item_key=keys.take(at), form=np.full(len(row), form, np.int32), size=np.full(len(row), k, np.int32), h=hashes.view(np.int64),
                        place=(starts - first[row]).astype(np.int32), windows=per[row].astype(np.int32), item_slots=_slots(values[form], plain, starts, k).cast(schema.field("item_slots").type),
                    )


@tidy
def _of_documents(batches: Iterator[pa.RecordBatch], schema: pa.Schema, sizes: list[int], literals: float, bitmap: np.ndarray) -> Iterator[pa.RecordBatch]:
    units, common, mask = _hashes_of(UNITS), _hashes_of(COMMON), _U((1 << BITMAP_BITS) - 1)
    for rows in batches:
        ids, keys = rows.column("id"), rows.column("key")
        for chunk in chunks(rows.column("text")):
            values, plain, first = templates(chunk, units, common)
            # equal templates meet whatever their forms, so a window's template goes out once
            differ = {(f, g): _below(values[f] != values[g]) for f in FORMS for g in range(f)}
            for k in sizes:
                for form in FORMS:
                    starts, row, hashes = _windows(values, form, first, k, literals)
                    hit = bitmap[(hashes & mask).astype(np.int64)]
                    starts, row, hashes = starts[hit], row[hit], hashes[hit]
                    new = np.ones(len(starts), dtype=bool)
                    for earlier in range(form):
                        new &= differ[form, earlier][starts + k] > differ[form, earlier][starts]
                    starts, row, hashes = starts[new], row[new], hashes[new]
                    at = pa.array(row + chunk.first)
                    yield batch(
                        schema, doc_id=ids.take(at), doc_key=keys.take(at), size=np.full(len(row), k, np.int32), h=hashes.view(np.int64), at=starts - first[row],
                        doc_slots=_slots(values[form], plain, starts, k).cast(schema.field("doc_slots").type),
                    )


def _probes(known: DataFrame, found: DataFrame, min_coverage: float) -> DataFrame:
    """Windows of which a document needs one at least to hold the item: size, h, item_id, item_key.

    Of an item's W windows in a form, a document needs ``ceil(min_coverage * W)``; so of any W + 1 less that number, it has one.
    Taken are those that the fewest windows of all documents equal. A window that no document has is rarest, and drops out.
    """
    times = found.groupBy("size", "h").agg(F.count(F.lit(1)).alias("times"))
    counted = known.select("item_id", "item_key", "form", "size", "h", "place", "windows").join(times, ["size", "h"], "left").fillna(0, "times")
    # coverage is rounded to four places before it is compared, so a little less may do
    needed = F.greatest(F.ceil(F.col("windows") * (min_coverage - 0.0001)), F.lit(1))
    rarest = Window.partitionBy("item_id", "item_key", "form").orderBy("times", "h", "place")
    picked = counted.withColumn("nth", F.row_number().over(rarest)).where((F.col("nth") <= F.col("windows") - needed + 1) & (F.col("times") > 0))
    return picked.select("size", "h", "item_id", "item_key").distinct()


def _hits(found: DataFrame, known: DataFrame, min_coverage: float) -> DataFrame:
    """Equal windows of documents and items, for the pairs that a probe has chosen.

    Both joins that follow go by keys with the window's hash or the item in them, and a pair meets at most the item's windows,
    so neither a long document nor a common window is one task's work.
    """
    probes = _probes(known, found, min_coverage)
    pairs = found.select("doc_id", "doc_key", "size", "h").join(probes, ["size", "h"]).select("doc_id", "doc_key", "item_id", "item_key").distinct()
    pairs = pairs.toDF("_doc_id", "_doc_key", "_item_id", "_item_key")
    wanted = pairs.join(known, F.col("_item_id").eqNullSafe(F.col("item_id")) & (F.col("_item_key") == F.col("item_key"))).drop("_item_id", "_item_key")
    wanted = wanted.withColumnsRenamed({"size": "_size", "h": "_h"})
    same = F.col("_doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_doc_key") == F.col("doc_key")) & (F.col("_size") == F.col("size")) & (F.col("_h") == F.col("h"))
    return found.join(wanted, same).drop("_doc_id", "_doc_key", "_size", "_h")


def find_leaks(docs: DataFrame, benchmark: DataFrame, size: int = 8, literals: float = 0.6, min_coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Row for each document and item whose template it holds: doc_id, item_id, n_windows (of the item, found), coverage,
    n_changed (distinct values that differ), kind (``exact`` or ``changed``), first_word (of the document, from 0).

    A window is ``size`` consecutive words (the whole item, if it is shorter). Plain windows are all usable, those of the other
    forms if a share ``literals`` or more of their words is no placeholder. So a copy of any item with a word is found; with
    changed values, an item is found only by windows of that share. An item is held if, in one of the FORMS, ``min_coverage`` of its usable windows are found on diagonals whose
    values are consistent; plain windows count on diagonals where the values of NUMBERS and INNER_NAMES are.
    Items without words can't be found. Null or empty texts hold nothing.
    Rows that share a document id count as one document, repeated items as one; null ids form a document, or item, of their
    own. Any length of text; each is read whole. An empty benchmark or corpus gives no rows.
    """
    items = pick(benchmark, id=item_col, text=item_text_col).where("text is not null").dropDuplicates().withColumn("key", F.xxhash64("text"))
    kind = items.schema["id"].dataType.simpleString()
    ddl = f"item_id {kind}, item_key long, form int, size int, h long, place int, windows int, item_slots array<long>"
    schema = arrow_schema(ddl)
    known = scratch(items.mapInArrow(lambda b: _of_items(b, schema, size, literals), ddl), "benchmark-windows")
    sizes = [r["size"] for r in known.select("size").distinct().collect()]  # at most ``size`` of them
    bitmap = np.zeros(1 << BITMAP_BITS, dtype=bool)
    bitmap[known.select(F.col("h").bitwiseAND((1 << BITMAP_BITS) - 1).alias("h")).distinct().toArrow().column("h").to_numpy()] = True
    rows = pick(docs, id=id_col, text=text_col).where("text is not null").withColumn("key", F.xxhash64("text"))
    doc_ddl = f"doc_id {rows.schema['id'].dataType.simpleString()}, doc_key long, size int, h long, at long, doc_slots array<long>"
    doc_schema = arrow_schema(doc_ddl)
    found = scratch(rows.mapInArrow(lambda b: _of_documents(b, doc_schema, sizes, literals, bitmap), doc_ddl), "document-windows")
    hits = _hits(found, known, min_coverage).withColumn("diagonal", F.col("at") - F.col("place")).withColumn("pairs", F.arrays_zip(F.col("item_slots").alias("item"), F.col("doc_slots").alias("doc")))
    # a diagonal lines each word of the item up with one word, so what is gathered is bounded by the item's length
    gathered = []
    for f in FORMS:
        of = lambda c: F.when(F.col("form") == f, F.col(c))  # noqa: B023, E731
        gathered += [F.collect_set(of("place")).alias(f"places{f}"), F.array_distinct(F.flatten(F.collect_set(of("pairs")))).alias(f"pairs{f}"), F.max(of("windows")).alias(f"windows{f}"), F.min(of("at")).alias(f"first{f}")]
    lined = hits.groupBy("doc_id", "doc_key", "item_id", "item_key", "diagonal").agg(*gathered)
    consistent = [F.size(f"pairs{f}") == F.size(F.array_distinct(F.transform(f"pairs{f}", lambda p: p["item"]))) for f in FORMS]
    consistent[PLAIN] = consistent[NUMBERS] & consistent[INNER_NAMES]
    sides = [
        F.when(
            consistent[f] & (F.size(f"places{f}") > 0),
            F.struct(
                F.lit(f).alias("form"), F.col(f"windows{f}").alias("windows"), F.col(f"places{f}").alias("places"), F.col(f"first{f}").alias("first_word"),
                F.size(F.filter(f"pairs{f}", lambda p: p["item"] != p["doc"])).alias("changed"),
            ),
        )
        for f in FORMS
    ]
    lined = lined.select("doc_id", "item_id", "item_key", F.explode(F.array_compact(F.array(*sides))).alias("side")).select("doc_id", "item_id", "item_key", "side.*")
    held = lined.groupBy("doc_id", "item_id", "item_key", "form", "windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("n_windows"),
        F.min("first_word").alias("first_word"),
        F.min("changed").alias("n_changed"),
    )
    held = held.withColumn("coverage", F.round(F.col("n_windows") / F.col("windows"), 4)).where(F.col("coverage") >= min_coverage)
    # of an item's forms, and texts if its id has several: the one that is covered best
    best = held.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "n_windows", "n_changed", "first_word")).alias("b")).select("doc_id", "item_id", "b.*")
    return best.select("doc_id", "item_id", F.col("n_windows").cast("long").alias("n_windows"), "coverage", F.col("n_changed").cast("long").alias("n_changed"), F.when(F.col("n_changed") == 0, "exact").otherwise("changed").alias("kind"), "first_word")
