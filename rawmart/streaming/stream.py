"""Incremental staging as a Structured Streaming job.

The landing folder is a file source; each micro-batch goes through the same staging step and is
upserted with the recency guard, so a replayed batch (``foreachBatch`` is at-least-once) or a late
older file can never overwrite newer staging rows. ``trigger(availableNow=True)`` processes what
has landed and stops, which is the scheduled-run shape; the checkpoint holds the high-water mark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rawmart.operators.merge import merge_upsert, overwrite_partitions, partition_filter
from rawmart.schemas import RAW_PART


def stream_upsert(
    spark: SparkSession,
    landing_path: str,
    landing_schema: StructType,
    to_staging: Callable[[DataFrame], DataFrame],
    target_path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    with_partition: Callable[[DataFrame], DataFrame],
    checkpoint_location: str,
    recency: Sequence[str] = ("_order",),
    max_files_per_trigger: int | None = None,
    cluster_by: Sequence[str] = (),
    raw_path: str | None = None,
    raw_part: Callable[[DataFrame], DataFrame] | None = None,
    mart_path: str | None = None,
    to_mart: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Run the landing -> staging upsert until all landed files are processed; returns batches run.

    With ``raw_path`` each batch is also kept in the raw zone, in a folder of its own that a replay of the
    batch overwrites, partitioned by ``raw_part``'s column. With ``mart_path`` the partitions that the batch
    touched are rebuilt in the mart from staging, so staging and mart agree after every batch; a replay
    rebuilds them again.
    """
    reader = spark.readStream.schema(landing_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    landed = reader.json(landing_path)
    batches = []

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        if raw_path is not None:
            raw_part(batch).write.mode("overwrite").partitionBy(RAW_PART).parquet(f"{raw_path}/batch={epoch_id}")
        touched = merge_upsert(spark, target_path, with_partition(to_staging(batch)), keys, partition_by, cluster_by, recency=recency)
        if mart_path is not None and touched:
            staging = spark.read.parquet(target_path).where(partition_filter(partition_by, touched))
            overwrite_partitions(spark, mart_path, with_partition(to_mart(staging)), partition_by, cluster_by)
        batches.append(epoch_id)

    query = (
        landed.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(batches)
