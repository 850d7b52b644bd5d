"""Clustering over files by a space-filling order (S13): a filter on any of the cluster keys leaves most folders unread.

Each key is cut into 2**bits ranges of about equal rows. A row's cell interleaves the bits of its ranges (Z order), so a run of
cells is a box in all keys. A table that is partitioned by cell and has statistics of its keys is read by ``Store.read(between=...)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

CELL = "z_cell"


def _place(df: DataFrame, name: str) -> Column:
    """An order-preserving number for a key: a number as it is, a time in seconds, a text's first six bytes."""
    kind = df.schema[name].dataType
    if isinstance(kind, NumericType):
        return F.col(name).cast("double")
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(F.col(name), "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return F.unix_micros(F.col(name).cast("timestamp")).cast("double")


def with_cells(df: DataFrame, keys: Sequence[str], bits: int = 2) -> DataFrame:
    """``df`` with CELL, a number below 2**(bits * len(keys)); nulls lie in a key's first range.

    The ranges' bounds are approximate percentiles of all rows: (2**bits - 1) numbers for each key reach the driver.
    """
    parts = 1 << bits
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    bounds = df.agg(*[F.percentile_approx(_place(df, k), shares, 10000).alias(f"b{i}") for i, k in enumerate(keys)]).first()
    cell = F.lit(0)
    for i, k in enumerate(keys):
        place = F.lit(0)
        for b in bounds[f"b{i}"] or []:
            place = place + F.coalesce((_place(df, k) >= b).cast("int"), F.lit(0))
        for bit in range(bits):
            cell = cell + F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)), bit * len(keys) + i)
    return df.withColumn(CELL, cell.cast("int"))
