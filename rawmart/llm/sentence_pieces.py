"""Sampled SentencePiece encoding, and decoding.

A text's lattice has an edge for every vocabulary piece at every place. Forward filtering sums the weights of all paths to a
place, backward sampling walks from the end and draws each edge with its posterior probability; the draws come from a hash
of the row's key and the place, so a row always gets the same segmentation, wherever and how often it runs.

No piece of the vocabulary reaches from a sign that is no space into a space, so every path cuts there: the lattice is the
chain of the lattices of the units in between (spaces and what follows them), and equal units share one forward pass.

The model orders its pieces by rank; an edge's log weight is ``-theta * log(rank + 1)`` (Zipf's law over the ranks). Bytes of
a character that is no piece of its own, and of the sign U+2581 itself (which stands for a space in pieces), take the
model's byte pieces, so any text comes back from its ids unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Words, arrow_schema, batch, bound_batches, chunks, distinct, list_array, mix, pick, ranges, run_hash, tidy, utf8

_U = np.uint64
_BYTE = np.uint8
#: what stands for a space in pieces
SPACE = "▁".encode()
#: text bytes whose lattices are held at a time
LATTICE_BYTES = 1 << 18


class Pieces:
    """A vocabulary as a byte trie (next state by state and byte; 0 is dead), with weights and bytes by id.

    Without ``theta`` only the bytes by id, which is what decoding needs.
    """

    def __init__(self, model: bytes, theta: float | None = 1.0):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = p.get_piece_size()
        self.raw: list[bytes] = []
        self.byte_id = np.zeros(256, dtype=np.int32)
        normal = []
        for i in range(n):
            if p.is_byte(i):
                value = int(p.id_to_piece(i)[3:5], 16)
                self.byte_id[value] = i
                self.raw.append(bytes([value]))
            elif p.is_control(i) or p.is_unknown(i) or p.is_unused(i):
                self.raw.append(b"")
            else:
                piece = p.id_to_piece(i).encode().replace(SPACE, b" ")
                self.raw.append(piece)
                if b" " not in piece.lstrip(b" ") or not piece.strip(b" "):
                    normal.append((piece, i))
        sizes = np.array([len(x) for x in self.raw])
        self.bytes = np.frombuffer(b"".join(self.raw), dtype=_BYTE)
        self.at, self.size = np.cumsum(sizes) - sizes, sizes
        self.longest = int(sizes.max()) + 1
        if theta is None:
            return
        order = sorted(range(len(normal)), key=lambda k: -p.get_score(normal[k][1]))
        self.weight = np.full(n, -theta * np.log(len(normal) + 1.0))
        for rank, k in enumerate(order, 1):
            self.weight[normal[k][1]] = -theta * np.log(rank + 1.0)
        rows: list[dict[int, int]] = [{}, {}]
        ids = [-1, -1]
        for piece, i in normal:
            state = 1
            for c in piece:
                if c not in rows[state]:
                    rows[state][c] = len(rows)
                    rows.append({})
                    ids.append(-1)
                state = rows[state][c]
            ids[state] = i
        self.next = np.zeros((len(rows), 256), dtype=np.uint16 if len(rows) < 1 << 16 else np.int32)
        for state, row in enumerate(rows):
            for c, to in row.items():
                self.next[state, c] = to
        self.next = self.next.ravel()
        self.id = np.array(ids, dtype=np.int32)


_loaded: dict[tuple[int, float | None], Pieces] = {}


def _pieces(model: bytes, theta: float | None) -> Pieces:
    """Built once per worker process."""
    key = (hash(model), theta)
    if key not in _loaded:
        _loaded[key] = Pieces(model, theta)
    return _loaded[key]


def units(chunk) -> Words:
    """Runs of spaces with what follows them up to the next space, never across rows; they cover the chunk."""
    n = len(chunk.data)
    space = chunk.data == 0x20
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    if n:
        begin[chunk.offsets[:-1][chunk.offsets[:-1] < chunk.offsets[1:]]] = True
    starts = np.flatnonzero(begin)
    first = np.searchsorted(starts, chunk.offsets)
    return Words(starts, np.append(starts[1:], n), first, np.repeat(np.arange(len(first) - 1), np.diff(first)))


def _edges(p: Pieces, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (from, to, id) in the lattices of units whose bytes stand in ``data`` one after another; places are byte places, an end is the place behind."""
    n = len(data)
    stop = np.repeat(np.cumsum(size), size).astype(np.int32)
    at, here = np.arange(n, dtype=np.int32), np.ones(n, dtype=np.int32)
    begin, end, ids = [], [], []
    single = np.zeros(n, dtype=bool)  # a character at this place is a piece of its own
    lead = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))
    k = 0
    while len(at):
        here = p.next[here * 256 + data[at + k]].astype(np.int32)
        keep = here > 0
        at, here = at[keep], here[keep]
        found = p.id[here]
        hit = found >= 0
        k += 1
        begin.append(at[hit])
        end.append(at[hit] + k)
        ids.append(found[hit])
        single[at[hit]] |= lead[at[hit]] == k
        keep = at + k < stop[at]
        at, here = at[keep], here[keep]
    start = np.flatnonzero((data & 0xC0) != 0x80)
    plain = np.zeros(n, dtype=bool)
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    if n:
        plain = single[start][np.maximum(char, 0)]
    byte = np.flatnonzero(~plain).astype(np.int32)
    return np.concatenate([*begin, byte]), np.concatenate([*end, byte + 1]), np.concatenate([*ids, p.byte_id[data[byte]]])


class Lattice:
    """Forward pass over distinct units: for each place, the edges into it and their posterior probabilities."""

    def __init__(self, p: Pieces, data: np.ndarray, size: np.ndarray):
        begin, end, ids = _edges(p, data, size)
        head = (np.cumsum(size) - size).astype(np.int32)
        own = np.repeat(np.arange(len(size), dtype=np.int32), size)[begin]
        # nodes: a unit of k bytes has k + 1 of them
        self.base = head + np.arange(len(size), dtype=np.int32)
        total = len(data) + len(size)
        depth = end - head[own]
        # by depth, node and length, in the same order wherever the unit stands
        order = np.argsort((depth.astype(np.int64) * total + end + own) * p.longest + (end - begin))
        depth, node, self.begin, self.ids = depth[order], (end + own)[order], (begin + own)[order], ids[order]
        del begin, end, own, order, ids
        weight = p.weight[self.ids]
        alpha = np.full(total, -np.inf)
        alpha[self.base] = 0.0
        self.first, self.count = np.zeros(total, dtype=np.int32), np.zeros(total, dtype=np.int32)
        self.share = np.zeros(len(node))
        cuts = np.flatnonzero(np.diff(depth, prepend=-1)) if len(depth) else np.zeros(0, int)
        for a, b in zip(cuts, [*cuts[1:], len(depth)], strict=True):
            here = node[a:b]
            heads = np.flatnonzero(np.diff(here, prepend=-1))
            counts = np.diff(np.append(heads, b - a))
            value = alpha[self.begin[a:b]] + weight[a:b]
            top = np.repeat(np.maximum.reduceat(value, heads), counts)
            top[top == -np.inf] = 0.0  # a place inside a character that no path reaches
            value = np.exp(value - top)
            mass = np.add.reduceat(value, heads)
            at = here[heads]
            with np.errstate(divide="ignore"):
                alpha[at] = np.log(mass) + top[heads]
            self.share[a:b] = value / np.repeat(np.maximum(mass, 1e-300), counts)
            self.first[at], self.count[at] = a + heads, counts

    def sample(self, unit: np.ndarray, size: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A path for each occurrence of a unit: ids in order, one occurrence after another, and how many each has."""
        node = self.base[unit] + size
        goal = self.base[unit]
        who = np.flatnonzero(node > goal)
        node = node[who]
        drawn, owner = [], []
        while len(who):
            u = (mix(seed[who] + node.astype(_U) - goal[who].astype(_U)) >> _U(11)).astype(np.float64) * 2.0**-53
            lo = self.first[node]
            hi = lo + self.count[node] - 1
            edge = lo.copy()
            late = np.flatnonzero(hi > lo)
            while len(late):  # a place has few edges
                u[late] -= self.share[edge[late]]
                late = late[u[late] >= 0]
                edge[late] += 1
                late = late[edge[late] < hi[late]]
            drawn.append(self.ids[edge])
            owner.append(who)
            node = self.begin[edge]
            keep = node > goal[who]
            who, node = who[keep], node[keep]
        counts = np.zeros(len(unit), dtype=np.int64)
        for x in owner:
            counts[x] += 1
        out = np.zeros(int(counts.sum()), dtype=np.int32)
        last = np.cumsum(counts) - 1
        for back, (x, ids) in enumerate(zip(owner, drawn, strict=True)):
            out[last[x] - back] = ids
        return out, counts


@tidy
def _encode(batches: Iterator[pa.RecordBatch], schema: pa.Schema, model: bytes, theta: float, seed: int) -> Iterator[pa.RecordBatch]:
    p = _pieces(model, theta)
    for rows in batches:
        keys, key_offsets = utf8(rows.column("key"))
        hashes = run_hash(keys, key_offsets[:-1], key_offsets[1:])
        missing = np.asarray(rows.column("text").is_null())
        for chunk in chunks(rows.column("text"), LATTICE_BYTES):
            own = units(chunk)
            size = own.ends - own.starts
            shown, which = distinct(chunk.data, own.starts, own.ends)
            lattice = Lattice(p, chunk.data[ranges(own.starts[shown], size[shown])], size[shown])
            row_seed = mix(hashes[chunk.first : chunk.last] + _U(seed))
            place = (own.starts - chunk.offsets[own.row]).astype(_U)
            ids, counts = lattice.sample(which, size, mix(row_seed[own.row] ^ (place * _U(0xD6E8FEB86659FD95))))
            per_row = np.bincount(own.row, weights=counts, minlength=chunk.last - chunk.first).astype(np.int64)
            made = list_array(pa.array(ids, pa.int32()), per_row)
            if missing[chunk.first : chunk.last].any():
                made = pa.ListArray.from_arrays(made.offsets, made.values, mask=pa.array(missing[chunk.first : chunk.last]))
            m = chunk.last - chunk.first
            yield batch(schema, row=rows.column("row").slice(chunk.first, m), text=rows.column("text").slice(chunk.first, m), ids=made.cast(schema.field("ids").type))


@tidy
def _decode(batches: Iterator[pa.RecordBatch], schema: pa.Schema, model: bytes) -> Iterator[pa.RecordBatch]:
    p = _pieces(model, None)
    for rows in batches:
        for i in range(0, rows.num_rows, 256):
            part = rows.slice(i, 256)
            ids = part.column("ids")
            flat = np.asarray(ids.flatten())
            offsets = np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths().fill_null(0)))])
            size = p.size[flat]
            data = p.bytes[ranges(p.at[flat], size)]
            ends = np.concatenate([[0], np.cumsum(size)])[offsets].astype(np.int32)
            text = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
            text = pa.array([None if missing else x for x, missing in zip(text.to_pylist(), np.asarray(ids.is_null()), strict=True)], pa.binary()) if ids.null_count else text
            yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in list(schema)[:-1]], text.cast(pa.string())], schema=schema)


def encode(docs: DataFrame, model_path: str, theta: float = 1.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row for each row of ``docs``: doc_id, text, ids (array of int).

    The draws are seeded by ``seed`` and the row's id, so repeated rows get the same ids. A null text gives null ids, an
    empty one no ids; a null id counts as a key of its own. A greater ``theta`` prefers frequent (and longer) pieces more.
    ``model_path`` is read by the driver; the tasks get its bytes (a vocabulary file, of bounded size). Whole texts are
    encoded; memory holds the lattice of LATTICE_BYTES of text, or of the longest text.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    keyed, kind = _keyed(docs, id_col, text_col)
    ddl = f"row {kind}, text string, ids array<int>"
    schema = arrow_schema(ddl)
    out = keyed.mapInArrow(lambda b: _encode(b, schema, model, theta, seed), ddl)
    return out.withColumnRenamed("row", "doc_id")


def round_trip(docs: DataFrame, model_path: str, theta: float = 1.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass, so that each task has one Python worker: doc_id, text, ids, decoded; rows as theirs."""
    with open(model_path, "rb") as f:
        model = f.read()
    keyed, kind = _keyed(docs, id_col, text_col)
    ddl = f"row {kind}, text string, ids array<int>"
    middle, schema = arrow_schema(ddl), arrow_schema(f"{ddl}, decoded string")
    out = keyed.mapInArrow(lambda b: _decode(_encode(b, middle, model, theta, seed), schema, model), f"{ddl}, decoded string")
    return out.withColumnRenamed("row", "doc_id")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = pick(docs, id=id_col, text=text_col)
    return rows.select(F.col("id").alias("row"), F.coalesce(F.col("id").cast("string"), F.lit("\u0000")).alias("key"), "text"), rows.schema["id"].dataType.simpleString()


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """The rows of ``encoded`` with a column ``decoded``: the text of the ids. Null ids give null, no ids the empty text."""
    with open(model_path, "rb") as f:
        model = f.read()
    bound_batches(encoded.sparkSession)
    names = encoded.columns
    plain = encoded.toDF(*["ids" if c == ids_col else f"_c{i}" for i, c in enumerate(names)])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema) + ", decoded string"
    schema = arrow_schema(ddl)
    return plain.mapInArrow(lambda b: _decode(b, schema, model), ddl).toDF(*names, "decoded")
