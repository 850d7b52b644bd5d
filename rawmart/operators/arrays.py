"""Parallel JSON arrays -> one row per driver element."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawmart.functions import json_array, json_scalar


def align_arrays(
    df: DataFrame,
    driver_path: str,
    measure_paths: Mapping[str, str],
    payload: str = "payload",
    keep: tuple[str, ...] = (),
    driver_name: str = "time_text",
) -> DataFrame:
    """Explode the driver array with its offset and pick each measure at the same offset.

    Semantics of ``UNNEST(driver) WITH OFFSET LEFT JOIN UNNEST(measure) WITH OFFSET ON idx = idx``:
    rows with a NULL/empty driver array vanish; a measure that is missing, shorter, or holds a
    non-scalar at the offset gives NULL; measure elements past the driver's end are ignored; driver
    elements that are not non-null scalars are dropped after the offset is taken. No join is
    needed: the arrays are zipped (missing ones as empty arrays) and exploded with their offset.
    """
    names = list(measure_paths)
    empty = F.array().cast("array<variant>")
    # zip first, so each exploded row carries only its own elements; carrying the whole measure
    # arrays past the explode is cheap only while whole-stage codegen keeps them as variables (a
    # fallback or a row copy would copy every array once per element)
    arrays = df.select(
        *keep,
        F.coalesce(json_array(payload, driver_path), empty).alias("_drv"),
        *[F.coalesce(json_array(payload, p), empty).alias(f"_m_{name}") for name, p in measure_paths.items()],
    )
    zipped = F.arrays_zip(F.col("_drv"), *[F.col(f"_m_{name}") for name in names])
    exploded = arrays.select(*keep, F.posexplode(zipped).alias("pos", "_e"))
    out = exploded.select(
        *keep,
        F.col("pos").cast("bigint").alias("pos"),  # INT64 offset, as WITH OFFSET
        json_scalar(F.col("_e")["_drv"]).alias(driver_name),
        *[json_scalar(F.col("_e")[f"_m_{name}"]).alias(name) for name in names],
    )
    # rows past the driver's end (a longer measure) and null/non-scalar driver elements drop here;
    # a missing or shorter measure pads with NULL, as the LEFT JOIN on the offset does
    return out.where(F.col(driver_name).isNotNull())
