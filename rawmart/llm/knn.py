"""Exact top-k search by a Voronoi kNN join, scored by the integer inner product.

Pivots split the rows into Voronoi cells. A cell's summary (its radius and longest vector) bounds the score of any of its rows
with a query: by Cauchy-Schwarz, ``q.x <= q.p + |q| * |x - p|`` and ``q.x <= |q| * |x|``. The pivots are rows themselves, so the
k-th best score of a query with them is a floor under its k-th best score. A query is only sent to cells whose bound reaches
its floor; of the two sides the queries are the smaller one, so they are what is replicated. A cell's rows are cut into blocks,
and the queries sent to it into parts, of bounded size; a row goes once to each part of its own cell, and not at all where no
query asks for the cell. Each block and part is solved locally.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .text import arrow_schema, batch, list_array, pick, scratch

#: rows of a cell, and queries sent to it, that meet in one task at a time
BLOCK_ROWS, BLOCK_QUERIES = 4096, 4096
#: pivots are the square root of the number of rows, within these bounds
LEAST_PIVOTS, MOST_PIVOTS = 128, 2048


def _quantised(batches: Iterator[pa.RecordBatch], schema: pa.Schema, scale: int) -> Iterator[pa.RecordBatch]:
    """floor(scale * x) of the rows that have only finite components, as a binary of int64."""
    for rows in batches:
        vectors = rows.column("vector")
        keep, packed = [], []
        for i, v in enumerate(vectors):
            x = v.values
            if x is None or x.null_count:
                continue
            x = np.floor(scale * x.to_numpy(zero_copy_only=False).astype(np.float64))
            if np.isfinite(x).all():
                keep.append(i)
                packed.append(x.astype(np.int64).tobytes())
        yield batch(schema, vec_id=rows.column("vec_id").take(pa.array(keep, pa.int64())), v=pa.array(packed, pa.binary()))


def _matrix(column: list[bytes], dim: int) -> np.ndarray:
    """Rows of int64, shorter ones filled up with zeros."""
    out = np.zeros((len(column), dim), dtype=np.int64)
    for i, x in enumerate(column):
        out[i, : len(x) // 8] = np.frombuffer(x, np.int64)
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products a @ b.T: by floats while no sum can pass 2**53, else by integers."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _assign(batches: Iterator[pa.RecordBatch], schema: pa.Schema, pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    p = pivots.astype(np.float64)
    for whole in batches:
        for i in range(0, whole.num_rows, 4096):
            rows = whole.slice(i, 4096)
            x = _matrix(rows.column("v").to_pylist(), pivots.shape[1]).astype(np.float64)
            distance = (x**2).sum(axis=1)[:, None] - 2 * x @ p.T + (p**2).sum(axis=1)[None, :]
            cell = distance.argmin(axis=1)
            radius = np.sqrt(((x - p[cell]) ** 2).sum(axis=1))
            yield batch(schema, row=rows.column("row"), vec_id=rows.column("vec_id"), v=rows.column("v"), cell=cell.astype(np.int32), radius=radius, norm=np.sqrt((x**2).sum(axis=1)))


def _route(batches: Iterator[pa.RecordBatch], schema: pa.Schema, pivots: np.ndarray, pivot_ids: np.ndarray, cells: np.ndarray, radius: np.ndarray, norm: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Each query with the cells that may hold one of its k best; ``floor``: a score that its k-th best reaches."""
    for whole in batches:
        for i in range(0, whole.num_rows, 1024):
            rows = whole.slice(i, 1024)
            q = _matrix(rows.column("v").to_pylist(), pivots.shape[1])
            score = _scores(q, pivots)
            other = np.where(rows.column("vec_id").to_numpy()[:, None] == pivot_ids[None, :], np.iinfo(np.int64).min, score)
            floor = np.sort(other, axis=1)[:, -k] if other.shape[1] >= k else np.full(len(q), np.iinfo(np.int64).min)
            length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))[:, None]
            bound = np.minimum(score[:, cells] + length * radius[None, :], length * norm[None, :])
            bound += 1e-9 * (np.abs(score[:, cells]) + length * (radius + norm)[None, :]) + 1  # rounding
            hit = bound >= floor[:, None]
            where = pa.array(cells[np.nonzero(hit)[1]].astype(np.int32))
            yield batch(schema, row=rows.column("row"), query_id=rows.column("vec_id"), q=rows.column("v"), floor=floor, cells=list_array(where, hit.sum(axis=1)).cast(schema.field("cells").type))


def _local(data: pa.Table, queries: pa.Table, schema: pa.Schema, dim: int, k: int) -> pa.Table:
    """The k best rows of a block for each of its queries, of those that reach the query's floor."""
    ids, x = data.column("vec_id").to_numpy(), _matrix(data.column("v").to_pylist(), dim)
    query_ids, q, floor = queries.column("query_id").to_numpy(), _matrix(queries.column("q").to_pylist(), dim), queries.column("floor").to_numpy()
    out: list[tuple] = []
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    for i in range(0, len(query_ids), 256):
        score = _scores(q[i : i + 256], x)
        good = (score >= floor[i : i + 256, None]) & (query_ids[i : i + 256, None] != ids[None, :])
        for r in np.flatnonzero(good.any(axis=1)):
            at = np.flatnonzero(good[r])
            at = at[np.argsort(-score[r, at], kind="stable")[:k]]  # ids ascend, so ties go to the smaller
            out.append((np.full(len(at), query_ids[i + r]), ids[at], score[r, at]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
    return pa.Table.from_arrays([pa.array(c) for c in columns], schema=schema)


def _shares(n_rows: dict[int, int], n_queries: dict[int, int]) -> list[tuple[int, int, int]]:
    """(cell, its blocks of rows, its parts of queries) of the cells that a query asks for."""
    return [(cell, n_rows[cell] // BLOCK_ROWS + 1, n // BLOCK_QUERIES + 1) for cell, n in sorted(n_queries.items())]


def _dealt(placed: DataFrame, routes: DataFrame, shares: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and queries by (cell, block, part): a row in one block and all parts of its cell, a query in one part and all blocks."""
    data = placed.join(F.broadcast(shares), "cell")  # at most a row for each pivot
    data = data.select("cell", F.pmod(F.xxhash64("row"), "blocks").alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "vec_id", "v")
    sent = routes.withColumn("cell", F.explode("cells")).join(F.broadcast(shares), "cell")
    sent = sent.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("row"), "parts").alias("part"), "query_id", "q", "floor")
    return data, sent


def top_k(vectors: DataFrame, queries_where, k: int = 5, scale: int = 256, pivots: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row that ``queries_where`` (a function of the id column) holds for: its ``k`` best other rows by score.

    Columns: query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id; all rows if there are fewer than k. A
    vector that is null, or has a null or non-finite component, takes no part, nor does a row with a null id. Rows that share an
    id are all candidates of other ids' queries; those of a query's id are its own, and queries with one id are ranked together. Vectors of
    different length are filled up with zeros. Components are scaled, floored and have to stay in the range of 64-bit integers.
    No rows: no result. ``pivots`` rows (the smallest by a hash of the id; by default between LEAST_PIVOTS and MOST_PIVOTS) are
    gathered on the driver; their number bounds what is broadcast, and doesn't bound the search.
    """
    rows = pick(vectors, vec_id=id_col, vector=vector_col).select(F.col("vec_id").cast("long").alias("vec_id"), "vector").where("vec_id is not null and vector is not null")
    ddl = "vec_id long, v binary"
    schema = arrow_schema(ddl)
    flat = rows.mapInArrow(lambda b: _quantised(b, schema, scale), ddl).withColumn("row", F.monotonically_increasing_id())
    flat = scratch(flat, "knn-vectors")
    spark = vectors.sparkSession
    n, dim = flat.agg(F.count(F.lit(1)), F.coalesce(F.max(F.octet_length("v")), F.lit(0)) / 8).first()
    pivots = pivots or min(max(math.isqrt(n), LEAST_PIVOTS), MOST_PIVOTS)
    chosen = flat.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(pivots).collect()
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = int(dim)
    pivot_ids, pivot = np.array([r["vec_id"] for r in chosen]), _matrix([bytes(r["v"]) for r in chosen], dim)
    cell_ddl = "row long, vec_id long, v binary, cell int, radius double, norm double"
    cell_schema = arrow_schema(cell_ddl)
    placed = scratch(flat.mapInArrow(lambda b: _assign(b, cell_schema, pivot), cell_ddl), "knn-cells")
    summary = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("radius"), F.max("norm").alias("norm")).orderBy("cell").collect()  # a row for each pivot at most
    cells, radius, norm = (np.array([r[c] for r in summary]) for c in ("cell", "radius", "norm"))
    asked = placed.where(queries_where(F.col("vec_id"))).select("row", "vec_id", "v")
    route_ddl = "row long, query_id long, q binary, floor long, cells array<int>"
    route_schema = arrow_schema(route_ddl)
    routes = scratch(asked.mapInArrow(lambda b: _route(b, route_schema, pivot, pivot_ids, cells, radius, norm, k), route_ddl), "knn-routes")
    n_queries = {r["cell"]: r["n"] for r in routes.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each pivot at most
    shares = spark.createDataFrame(_shares({r["cell"]: r["n"] for r in summary}, n_queries), "cell int, blocks long, parts long")
    data, sent = _dealt(placed, routes, shares)
    key = ["cell", "block", "part"]
    out_ddl = "query_id long, vec_id long, score long"
    out_schema = arrow_schema(out_ddl)
    best = data.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(lambda a, b: _local(a, b, out_schema, dim, k), out_ddl)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
