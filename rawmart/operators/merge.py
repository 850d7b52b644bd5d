"""Upsert by business key (M1-M3, J6, J7) on plain Parquet tables.

``merge_plan`` is the pure DataFrame form. ``merge_upsert`` writes it back, rewriting only the
partitions the source touches. That is exact only while the partition value is a function of the
merge key (true for all four zone tables: year bucket of ``year``, day of ``timestamp``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawmart.session import delete_path, list_names, materialize, partition_values, path_exists, scratch_scope, session_conf

DYNAMIC = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}


def merge_plan(target: DataFrame, source: DataFrame, keys: Sequence[str], recency: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``target`` after ``MERGE ... WHEN MATCHED UPDATE (all non-keys) WHEN NOT MATCHED INSERT``.

    ``source`` must already be unique per key (run ``latest_per_key`` first). Target rows without a
    source match are kept (nothing is deleted); a matched row is replaced whole, NULLs included.
    Rows with a NULL key never match, as in SQL, so they are inserted again.

    With ``recency`` (the staging ``_order`` struct, or e.g. ``["ingested_at", "extract_run_id"]``) a
    matched target row is replaced only when the source row is not older: the guard an incremental
    or streaming source needs.

    Only keys and recency values of the source meet the target, and both sides are key-unique, so there is
    no hot key. Spark broadcasts the source keys by their size in bytes (a written source has an exact one);
    target rows are then not shuffled at all.
    """
    cols = target.columns
    src = source.select(*cols)
    on = list(keys)
    if recency is None:
        keep = target.join(src.select(*keys).where(_not_null(keys)), on, "left_anti").select(*cols)
        return keep.unionByName(src)
    order = F.struct(*recency)
    theirs = src.where(_not_null(keys)).select(*keys, order.alias("_theirs"))
    met = target.join(theirs, on, "left").withColumn("_newer", F.col("_theirs").isNotNull() & (order > F.col("_theirs")))
    keep = met.where(F.col("_theirs").isNull() | F.col("_newer")).select(*cols)
    refused = met.where("_newer").select(*keys)  # source keys whose target row is newer: at most the source's rows
    return keep.unionByName(src.join(refused, on, "left_anti").select(*cols))


def _not_null(keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def merge_upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    recency: Sequence[str] | None = None,
) -> list[tuple]:
    """Upsert ``source`` into the Parquet table at ``path``, partitioned by ``partition_by``.

    1. an earlier upsert that was killed while it replaced partitions is finished first (``recover``);
    2. the source is written once as scratch (computed once, however expensive its staging logic); an
       aggregate over it gives the touched partition values (one row per partition);
    3. only those target partitions are read (a literal ``IN`` list becomes a PartitionFilter), merged, and
       the result is written to a journal folder beside the table;
    4. dynamic partition overwrite replaces exactly the touched partitions from the journal, each written
       by tasks of bounded size (``rebalance`` splits a hot partition) and sorted by the cluster keys; the
       journal is deleted last.

    Returns the touched partition values. A kill before the journal is complete leaves the table as it was;
    a kill after that is repaired by the next upsert or by ``recover``.
    """
    recover(spark, path, partition_by, cluster_by)
    with scratch_scope(spark):
        src = materialize(source, "upsert_source")
        touched = partition_values(src, partition_by)
        if not touched:
            return []
        existing = _read_existing(spark, path, src)
        if existing is None:
            overwrite_partitions(spark, path, src, partition_by, cluster_by)
            return touched
        merged = merge_plan(existing.where(partition_filter(partition_by, touched)), src, keys, recency)
        journal = f"{_journal(path)}/{uuid.uuid4().hex}"
        merged.write.mode("errorifexists").parquet(journal)
    _apply(spark, path, journal, merged.schema, partition_by, cluster_by)
    return touched


def _journal(path: str) -> str:
    return f"{path.rstrip('/')}.journal"


def _apply(spark: SparkSession, path: str, journal: str, schema, partition_by: Sequence[str], cluster_by: Sequence[str]) -> None:
    overwrite_partitions(spark, path, spark.read.schema(schema).parquet(journal), partition_by, cluster_by)
    delete_path(spark, journal)


def recover(spark: SparkSession, path: str, partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> int:
    """Finish upserts that were killed half-way: complete journals are applied again (which changes nothing
    that was already written), incomplete ones dropped. Returns how many were applied."""
    applied = 0
    for name in list_names(spark, _journal(path)):
        journal = f"{_journal(path)}/{name}"
        if path_exists(spark, f"{journal}/_SUCCESS"):
            _apply(spark, path, journal, spark.read.parquet(journal).schema, partition_by, cluster_by)
            applied += 1
        else:
            delete_path(spark, journal)
    return applied


def overwrite_partitions(spark: SparkSession, path: str, rows: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str] = ()) -> None:
    """Replace exactly the partitions that ``rows`` has; ``rows`` must not read the table."""
    out = rows.hint("rebalance", *partition_by)
    if cluster_by:
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    with session_conf(spark, DYNAMIC):
        out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def partition_filter(partition_by: Sequence[str], touched: Sequence[tuple]):
    """Predicate selecting exactly the given partition values (literal, so it prunes folders)."""
    if len(partition_by) == 1 and all(v[0] is not None for v in touched):
        return F.col(partition_by[0]).isin([v[0] for v in touched])
    cond = F.lit(False)
    for values in touched:
        part = F.lit(True)
        for col, val in zip(partition_by, values):
            part = part & (F.col(col).isNull() if val is None else F.col(col) == F.lit(val))
        cond = cond | part
    return cond


def _read_existing(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    """The target table, or None when its folder does not exist yet.

    Only a missing folder means "no table": any other read error propagates, because treating it as
    an empty target would overwrite the touched partitions with the source rows alone.
    """
    if not path_exists(spark, path):
        return None
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)
