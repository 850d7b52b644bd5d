"""Latest row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(c) -> Column:
    return F.col(c).desc() if isinstance(c, str) else c


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, drop_null_keys: bool = False) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (strings mean descending).

    ``row_number() = 1`` lets Catalyst plan a partial ``WindowGroupLimit`` before the shuffle, so each
    map task sends at most one row per key: a hot key costs no more shuffle than a cold one.
    The caller passes a total order (tie-breakers included) so the result does not depend on input order.
    """
    w = Window.partitionBy(*keys).orderBy(*[_order(c) for c in order])
    out = df
    if drop_null_keys:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        out = out.where(cond)
    return out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
