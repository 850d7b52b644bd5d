"""Readers for captured response bodies (the re-aimed fetch step, S9-S11).

Two layouts are supported, both read in parallel by Spark with no per-file driver work:

* a table of bodies (Parquet, or newline JSON with the ``INDICATOR_BODY`` / ``HOURLY_BODY`` schema);
* one captured response per file, with the request in the folder names, e.g.
  ``.../indicator_id=SP.POP.TOTL/page_no=2/response.json`` or
  ``.../location_id=london/source_variant=archive/response.json``. Each file is one row
  (``wholetext``), so a body is never split across rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rawmart import schemas as S


def read_body_table(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """A table of captured bodies; only the schema's columns are read."""
    reader = spark.read.schema(schema)
    return (reader.parquet(path) if fmt == "parquet" else reader.json(path)).select(*schema.fieldNames())


def read_body_files(spark: SparkSession, path: str, partition_schema: StructType) -> DataFrame:
    """One row per captured file: the request columns from the folder names, ``body`` the whole file,
    ``source_path`` its location. Partition column types come from ``partition_schema`` (no inference)."""
    schema = StructType([StructField("value", StringType(), True)])
    for f in partition_schema.fields:
        schema = schema.add(f)
    df = spark.read.option("wholetext", "true").schema(schema).text(path)
    return df.select(
        *partition_schema.fieldNames(),
        F.col("value").alias("body"),
        F.col("_metadata.file_path").alias("source_path"),
    )


INDICATOR_FILE_PARTS = StructType([S.INDICATOR_BODY["indicator_id"], S.INDICATOR_BODY["page_no"]])
HOURLY_FILE_PARTS = StructType([S.HOURLY_BODY["location_id"], S.HOURLY_BODY["source_variant"]])
